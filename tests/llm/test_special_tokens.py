"""Special tokens written in a text, against the tokenizers library with its defaults."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.cases import documents, texts
from tidemill.llm import records

MARK = "<|endoftext|>"


def test_special_tokens(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    special = [f"end{MARK}start", MARK, f"{MARK}{MARK} \n", f"snake_case {MARK} _x_", f"a <|endof {MARK[:-1]} {MARK.upper()}", f"café  {MARK}  123abc"]
    rows = [(i, t) for i, t in enumerate(dict.fromkeys(t for _, t in texts() if t))] + [(1000 + i, t) for i, t in enumerate(special)]
    folder = f"file://{tmp_path}/records"
    records.write_tokens(documents(spark, rows), folder, path, end_id=2)
    found = {r.key: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in records.read_tokens(spark, folder).collect()}
    assert found == {k: plain.encode(t, add_special_tokens=False).ids + [2] for k, t in rows}
    assert found[1000] == [437, 50256, 9688, 2]

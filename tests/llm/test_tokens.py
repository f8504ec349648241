import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from cases import LONG
from tokenizers import Tokenizer

from shoplens.llm import tokens


def texts():
    rnd = random.Random(4)
    parts = list("ab cD\n\t  'st 19 é ñ .,$<|>endoftext") + [" ", " ", "’", "中", "ß", "İ", "\x1c", "\x85", "don't", " 's", " ", "\U0001f600"]
    return ["".join(rnd.choices(parts, k=rnd.randrange(60))) for _ in range(2000)] + ["", None, "<|endoftext|> x", "a <|endoftext|> b", "<|startoftext|>a<|ENDOFTEXT|>", "x<|end", "oftext|>y", "<|endoftext|>" * 3, "a\n\nb", "  a  b ", "\n", LONG]


@pytest.mark.parametrize("name,keep_space,end", [("byte_bpe_50k.json", True, 0), ("word_bpe_49k.json", False, 2)])
def test_ids_equal_the_library(name, keep_space, end, monkeypatch):
    monkeypatch.setattr(tokens, "POOL_IDS", 20_000)        # the memo overflows and starts anew
    tokens._ENCODERS.clear()
    path, rows = public_tokenizers.path(name), texts()
    whole = Tokenizer.from_file(path)
    got = []
    for ids, off in tokens.encode_column(pa.array(rows, pa.string()), path, keep_space, end):
        got += [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])]
    tokens._ENCODERS.clear()
    assert got == [e.ids + [end] for e in whole.encode_batch([t or "" for t in rows], add_special_tokens=False)]


def test_added_tokens_get_their_ids():
    for name, keep_space, end, expect in (("byte_bpe_50k.json", True, 0, 4), ("word_bpe_49k.json", False, 2, 3)):
        ((ids, _),) = tokens.encode_column(pa.array(["a <|endoftext|> b"]), public_tokenizers.path(name), keep_space, end)
        assert len(ids) == expect + 1


def test_wide_space_is_found():
    data = np.frombuffer("a b c　".encode(), np.uint8)
    assert tokens._wide_space(data).tolist() == [1, 4, 8]

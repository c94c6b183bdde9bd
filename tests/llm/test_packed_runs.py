"""Runs of op3 are coded many to a text, with the ids the tokenizer gives each."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa

from spendstar.llm import pow2_pack
from spendstar.llm.common import buffers

TEXTS = ["The QUICK brown-fox, 2023; it's don't 12.5 </w> <|endoftext|>", "", None, "é ß×÷ ½ 中 a\x00b x y",
         " ".join(f"w{i}ord{'abc'[i % 3]}" for i in range(3000)), "</w>w/w> 0011 !!??", "w", "7"]


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **options)


def _check(ids, inner) -> None:
    flat, counts = ids.texts(*buffers(pa.array(TEXTS)))
    want = [e.ids for e in inner.encode_batch_fast([t or "" for t in TEXTS], add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want))
    assert np.array_equal(flat, np.concatenate([np.array(w, np.uint32) for w in want]))


def test_runs_are_coded_joined():
    ids = pow2_pack._Ids(public_tokenizers.path("word_bpe_49k.json"))
    inner = ids.tokenizer
    ids.tokenizer = Counted(inner)
    _check(ids, inner)
    assert len(ids.names) > 3000 and ids.tokenizer.texts < 100


def test_runs_are_coded_one_by_one_where_no_id_ends_a_part():
    ids = pow2_pack._Ids(public_tokenizers.path("word_bpe_49k.json"))
    ids.last[:] = False
    _check(ids, ids.tokenizer)

"""Encoding against the sentencepiece library: ids, spans and decoded text."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as spm
from llm.helpers import ODD, docs

from eddy.llm import pieces
from eddy.llm.queries import piece_model

TEXTS = ["", " ", "a", " a ", "hello  world\n\tfoo   ", "日本語 テスト 🎉🎉 xx", "▁▁ a ▁b▁ ", "x▁  y", "\x00a\x00 b\x00",
         "<s> </s> <0x41>", "a" * 500 + " " + "é" * 300, "     deep   indent", "ÀÈ 　wide", "\ufeff bom"]


@pytest.fixture(scope="module")
def model():
    return pieces.Model(piece_model())


def test_ids_and_spans_equal_the_library(model):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("ab é▁ 日🎉\n\t<s>zq\x00") for _ in range(r.randrange(60))) for _ in range(200)]
    library = spm.SentencePieceProcessor(model_file=model.path)
    for text, (ids, begin, end) in zip(texts, pieces.Encoder(model).encode(pa.array(texts))):
        want = library.encode(text, return_type="proto").pieces
        assert [p.id for p in want] == ids.tolist()
        assert [(p.begin, p.end) for p in want] == list(zip(begin.tolist(), end.tolist()))


def test_short_runs_with_unknown_characters_are_merged_together(model, monkeypatch):
    """Characters that are no piece (line breaks, rare scripts, the character 0) don't send
    a run of at most 32 characters to the single merges."""
    texts = ["end.\nNext line\n\n\t x", "日\U00020000本 \U0001f9ff\U0001f9ff a\x00b\x00", "\nq\n " * 40, "\x00", "\u1e9e\n"]
    library = spm.SentencePieceProcessor(model_file=model.path)
    want = [library.encode(t, return_type="proto").pieces for t in texts]
    monkeypatch.setattr(pieces.Model, "merge_one", None)
    for own, (ids, begin, end) in zip(want, pieces.Encoder(model).encode(pa.array(texts))):
        assert [(p.id, p.begin, p.end) for p in own] == list(zip(ids.tolist(), begin.tolist(), end.tolist()))
    # A model without byte pieces gives the unknown piece, as the single merges do.
    runs = ["a\nb".encode(), "▁日\U00020000".encode()]
    bare = pieces.Model(model.path)
    bare.bytes = {}
    first, ids, sizes = bare.merge_many(runs)
    monkeypatch.undo()
    assert list(zip(ids.tolist(), sizes.tolist())) == [p for r in runs for p in bare.merge_one(r)]
    assert first.tolist() == np.cumsum([0, *(len(bare.merge_one(r)) for r in runs)]).tolist()


def test_character_map_by_longest_prefix(model):
    """Normalisation and its alignment with a compiled map, against the library's."""
    rule = spm.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False,
                                       remove_extra_whitespaces=False)
    blob = dict(pieces._fields(bytes(rule.serialized_normalizer_spec() if callable(rule.serialized_normalizer_spec)
                                     else rule.serialized_normalizer_spec)))[2]
    own = pieces.Model(model.path)
    own.charmap, own.dummy_prefix, own.trim, own.escape = pieces.CharMap(blob), False, False, False
    for text in ["plain", "ﬁne Ⅷ ①", "ｆｕｌｌ　width", "e\u0301 ガ", "㍿ a\u200bb", "\t x"]:
        norm, source = own.normalise(text.encode())
        assert norm.decode() == rule.normalize(text)
        assert len(source) == len(norm) + 1 and source[-1] == len(text.encode())
        assert (np.diff(source) >= 0).all()


def test_query_columns_and_odd_rows(spark, model):
    d = docs(spark, ODD)
    library = spm.SentencePieceProcessor(model_file=model.path)
    got = sorted(pieces.digests(d, model.path).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    want = sorted(((i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest(), len((t or "").encode()))
                   for i, t, _ in ODD for ids in [library.encode(t or "", add_bos=True, add_eos=True)]),
                  key=lambda r: r[:2])
    assert [((r.doc_id or 0), *r[1:]) for r in got] == want
    full = pieces.encode(d, model.path).collect()
    assert all(len(r.ids) == len(r.begin) == len(r.end) for r in full) and len(full) == len(ODD)
    assert pieces.digests(d.limit(0), model.path).count() == 0

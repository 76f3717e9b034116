"""SentencePiece and token counts, held against the library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from conftest_llm import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from skyops.llm import queries, sentencepiece_codec, token_counts
from skyops.llm.pieces import _merge_long, load, merge, splitter

PATH = public_tokenizers.path(queries.PIECES)
VOCAB = load(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
ENCODER = sentencepiece_codec.Encoder(VOCAB)
SPLIT = splitter(VOCAB)
TEXT = st.text(st.sampled_from(" ▁\n\tabcdeinorst.,!_'\"áéñ的中é①😀　0129<>#$THE"), max_size=60) | st.text(max_size=30)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_backtracking_gives_the_library_ids(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = [i for c in SPLIT(text) for i in ENCODER.ids(c)]
    assert ids == LIBRARY.encode(text)
    assert token_counts.counter(VOCAB)(text) == len(ids)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 18, 31, 33, 50])
def test_runs_of_one_character(n):
    for text in (" " * n, "a" + " " * n + "b", "a" * n, "=" * n, "\n" * n, "0" * n):
        assert [i for c in SPLIT(text) for i in ENCODER.ids(c)] == LIBRARY.encode(text)


def test_both_ways_of_merging_agree():
    for text in ("thereinthe" * 4, "▁▁▁▁▁▁▁a▁▁", "q" * 50, "的中的"):
        assert merge(text, VOCAB.ranks) == _merge_long(text, VOCAB.ranks)


def test_a_long_word_without_spaces():
    text = "internationalisationtheandof" * 3000
    assert [i for c in SPLIT(text) for i in ENCODER.ids(c)] == LIBRARY.encode(text)


def test_only_strings_that_stay_whole_are_counted_directly():
    assert all(LIBRARY.encode(p.replace("▁", " "))[-1] for p in list(VOCAB.single)[:50])
    assert all(merge(p, VOCAB.ranks) == [p] for p in list(VOCAB.single)[::97])


def test_another_kind_of_model_is_refused(tmp_path):
    with pytest.raises(Exception):  # noqa: B017  the library's own error
        load(str(tmp_path / "none.model"))


def test_encode_decode_and_count(docs_of):
    docs = docs_of(ODD)
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PATH), PATH)
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        want = LIBRARY.encode(r.text or "", add_eos=True)
        assert (r.ids, r.decoded) == (want, LIBRARY.decode(want))
    for r in token_counts.count_tokens(docs, PATH).collect():
        assert r.n_tokens == len(LIBRARY.encode(r.text or ""))


def test_decode_of_bytes_that_are_no_text(spark):
    ids = [[VOCAB.byte_ids[0xE2], VOCAB.byte_ids[0x82], 264], [], None, [2, 264], [VOCAB.byte_ids[0xFF]] * 2 + [1]]
    df = spark.createDataFrame([(x,) for x in ids], "ids array<int>").coalesce(1)
    got = [r.decoded for r in sentencepiece_codec.decode(df, PATH).collect()]
    assert got == [LIBRARY.decode(x) if x else "" for x in ids]


def test_empty_table(docs_of):
    docs = docs_of([(1, "a")]).where("doc_id > 5")
    assert sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PATH), PATH).collect() == []
    assert token_counts.count_tokens(docs, PATH).collect() == []


def test_queries_on_the_small_tables(spark, small):
    got = {r.doc_id: r for r in queries.QUERIES["op3_sentencepiece"](spark, small).collect()}
    counts = {r.doc_id: r for r in queries.QUERIES["op6_token_counts"](spark, small).collect()}
    docs = queries.table(spark, small, "documents").collect()
    assert len(got) == len(counts) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_eos=True)
        r, c = got[d.doc_id], counts[d.doc_id]
        assert r.n_tokens == len(ids) and c.n_tokens == len(ids) - 1 and c.over_limit == (len(ids) - 1 > 4096)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
        assert c.n_bytes == len((d.text or "").encode())


def test_both_ways_at_once_equal_one_after_the_other(docs_of):
    path = public_tokenizers.path(queries.PIECES)
    docs = docs_of([*ODD, (20, "</s><unk> é ▁ \U0001f600"), (21, "a\x00b")])
    one = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path)
    both = sentencepiece_codec.encode_and_decode(docs, path)
    assert both.columns == one.columns
    assert sorted(map(str, both.collect())) == sorted(map(str, one.collect()))

"""Encoding, wavelet shards and packing against the tokenizer itself."""

import zlib

import numpy as np
import pytest
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from hirelake.llm.chat import format_conversations
from hirelake.llm.packing import Limits, Packer, pack_documents
from hirelake.llm.tokens import Encoder
from hirelake.llm.wavelet import Plane, WaveletMatrix, dump, load, read_shards, write_shards

FILE = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def ids_of(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_words_give_the_ids_of_texts(tokenizer, given):
    e = Encoder(FILE, True, most_words=500)
    for _, text, *_ in given("documents")[1]:
        assert e.ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_text_with_a_new_word_is_looked_up_once():
    e, asked = Encoder(FILE, True), []

    class Noted(type(e.known)):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    e.known = Noted(e.tokenizer)
    long = "x" * 65
    got = e.ids(["one two " * 100, "one two " * 100 + f"three {long}"])
    assert [w for w in asked if w != "one" and w != "two"] == ["three", long] and len(asked) == 402
    assert [g.tolist() for g in got] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in ("one two " * 100, "one two " * 100 + f"three {long}")]
    assert e.known.keys() == {"one", "two", "three"}


@settings(max_examples=300, deadline=None)
@examples(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZéßÇñ'.,<|>  \n\x1c ́İ1s"))))
def test_any_text(text):
    plain = Tokenizer.from_file(FILE) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = plain
    test_any_text.e = e = getattr(test_any_text, "e", None) or Encoder(FILE, True)
    assert e.ids([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_special_strings(tokenizer):
    for text in ("a <|endoftext|> b", "x<|startoftext|>", "it's can't I'LL", "w" * 300 + "."):
        assert Encoder(FILE, True).ids([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plane_rank_and_select():
    bits = np.random.default_rng(1).random(3000) < 0.3
    p = Plane.of(bits)
    at = np.arange(3001)
    assert (p.rank1(at) == np.concatenate(([0], np.cumsum(bits)))).all()
    assert (p.select(np.arange(bits.sum()), 1) == np.flatnonzero(bits)).all()
    assert (p.select(np.arange((~bits).sum()), 0) == np.flatnonzero(~bits)).all()
    assert (p.bits(3000) == bits).all()


@pytest.mark.parametrize("n", [0, 1, 512, 5000])
def test_wavelet_matrix(n):
    ids = np.random.default_rng(n).integers(0, 40, n).astype(np.uint32)
    _, _, w = load(dump([1, None], np.array([n, n]), ids, 6))
    assert (w.decode() == ids).all()
    assert (w.access(np.arange(n)) == ids).all()
    for symbol in (0, 7, 39, 63, 64):
        where = np.flatnonzero(ids == symbol)
        assert (w.occurrences(symbol) == where).all() and w.count(symbol) == len(where)
        assert w.count(symbol, n // 3, n // 2) == ((where >= n // 3) & (where < n // 2)).sum()
    assert WaveletMatrix.build(ids, 6).n == n


def shards(spark, df, tmp_path, **kw):
    write_shards(df, str(tmp_path / "w"), FILE, 2, 16, by_word=True, **kw)
    return read_shards(spark, str(tmp_path / "w")).collect()


def check_shards(got, rows, tokenizer):
    got = sorted(got, key=lambda r: r.start)
    start = 0
    for r, (i, text) in zip(got, sorted(rows), strict=True):
        ids = ids_of(tokenizer, text, 2)
        assert tuple(r) == (i, start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_shards_round_trip(spark, given, tmp_path, tokenizer):
    df, rows = given("documents")
    check_shards(shards(spark, df, tmp_path, shard_tokens=5000), [r[:2] for r in rows], tokenizer)


def test_shards_of_awkward_rows(spark, documents, awkward, tmp_path, tokenizer):
    rows = list(enumerate(awkward))
    check_shards(shards(spark, documents(awkward), tmp_path), rows, tokenizer)


def test_shards_of_null_ids_and_empty_tables(spark, documents, tmp_path):
    got = shards(spark, documents(["b", "a", "c"], [None, 5, 5]), tmp_path)
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, 5, 5]
    (tmp_path / "x").mkdir()
    assert shards(spark, documents([]), tmp_path / "x") == []


def check_pieces(df, rows, tokenizer, limits):
    got = [r.asDict() for r in pack_documents(df, FILE, 1, limits, by_word=True).collect()]
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in rows:
        ids, at = ids_of(tokenizer, text, 1), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(r["n_loss"] for r in pieces) <= limits.loss
        short += at < limits.tokens
    return short


def test_packed_documents(given, tokenizer):
    df, rows = given("documents")
    short = check_pieces(df.coalesce(1), [r[:2] for r in rows], tokenizer, Limits(2048, 64, 2048))
    assert short <= 1


def test_packed_awkward_rows(documents, awkward, tokenizer):
    check_pieces(documents(awkward), list(enumerate(awkward)), tokenizer, Limits(64, 3, 50))
    assert pack_documents(documents([]), FILE, 1).count() == 0


def test_loss_spans_of_conversations(given, tokenizer):
    limits = Limits(512, 6, 60)
    formatted = format_conversations(given("conversations")[0].limit(2000)).withColumnRenamed("conv_id", "doc_id").coalesce(1)
    rows = formatted.collect()
    assert {r.part for r in rows} == {0}
    got = pack_documents(formatted, FILE, 1, limits, learned="loss").collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.n_loss
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in rows:
        learned = {i for x in r.loss for i in range(x.s, x.e)}
        offsets = tokenizer.encode(r.text, add_special_tokens=False).offsets
        assert by_doc[r.doc_id] == sum(not learned.isdisjoint(range(*o)) for o in offsets) + (len(r.text) - 1 in learned)
    full = {"tokens": 0, "segments": 0, "loss": 0}
    for pieces in by_sequence.values():
        used = {"tokens": sum(r.length for r in pieces), "segments": len(pieces), "loss": sum(r.n_loss for r in pieces)}
        for k in full:
            assert used[k] <= getattr(limits, k)
            full[k] += used[k] == getattr(limits, k)
    assert full["loss"] > len(by_sequence) / 2


def test_loss_spans_of_awkward_rows(spark):
    texts = ["one two three", "one two three", None, "", "é ß 😀 tail", "x"]
    spans = [[(4, 7)], None, [(0, 5)], [], [(-3, 1), (0, 99)], [(0, None)]]
    df = spark.createDataFrame(
        list(zip(range(6), texts, spans, strict=True)), "doc_id long, text string, learned array<struct<s:int,e:int>>"
    )
    got = {r.doc_id: (r.doc_tokens, r.n_loss) for r in pack_documents(df, FILE, 1, learned="learned").collect()}
    assert got[0] == (4, 1) and got[1] == (4, 0) and got[2] == (1, 0) and got[3] == (1, 0)
    assert got[4][0] == got[4][1] and got[5][1] == 0
    assert pack_documents(df.limit(0), FILE, 1, learned="learned").count() == 0


@settings(max_examples=100, deadline=None)
@examples(
    st.lists(st.lists(st.booleans(), max_size=90), max_size=40),
    st.integers(1, 50), st.integers(1, 5), st.integers(1, 40), st.booleans(),
)
def test_packer_keeps_its_limits(masks, tokens, segments, loss, cut):
    p = Packer(Limits(tokens, segments, loss), pool=4, cut=cut)
    pieces = [x for i, m in enumerate(masks) for x in p.add(i, np.array(m, int))] + list(p.finish())
    seen, sequences = {i: 0 for i in range(len(masks))}, {}
    for name, a, b, sequence, offset in pieces:
        assert a == seen[name] and b > a
        seen[name] = b
        sequences.setdefault(sequence, []).append((offset, b - a, sum(masks[name][a:b])))
    assert all(seen[i] == len(m) for i, m in enumerate(masks))
    for content in sequences.values():
        assert [o for o, _, _ in content] == list(np.cumsum([0] + [n for _, n, _ in content])[:-1])
        assert sum(n for _, n, _ in content) <= tokens and len(content) <= segments
        assert sum(x for _, _, x in content) <= loss

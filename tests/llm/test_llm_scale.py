"""Behaviour that matters at scale: hot keys, equal rows, many blocks, any text."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import decontaminate, mixing, sharding, tokenid, urlfilter, warc
from lakeline.llm.wordpieces import encoder


def ranges(spark, docs, shards):
    """Rows and bytes of each range, and the rows' ranges by plain comparison."""
    rows = sharding.written(sharding.keyed(docs), "keys")
    bounds, measured = sharding.split(rows, shards)
    got = [(tuple(r[:3]), r["range"]) for r in sharding._assigned(rows, bounds).select(*sharding.KEY, "range").collect()]
    assert bounds == sorted(set(bounds))
    keys = np.array([k for k, _ in got])
    for key, at in got[::max(1, len(got) // 2000)]:
        assert bounds[at] <= key and (at + 1 == len(bounds) or key < bounds[at + 1])
    assert len(keys) == sum(n for _, n in measured)
    return measured


def test_ranges_are_bounded_by_rows_and_bytes(spark):
    n = 60_000
    half = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN '' ELSE repeat(concat('text ', id), cast(20 + id % 50 AS int)) END AS text")
    found = ranges(spark, half, 6)
    rows, size = [r for _, r in found], [s for s, _ in found]
    assert max(rows) <= 2 * sum(rows) / len(rows) and max(size) <= 2.2 * sum(size) / (6 * sharding.RANGES)


@pytest.mark.parametrize("who", ["cast(NULL AS bigint)", "7L"])
def test_equal_rows_are_cut_like_others(spark, who):
    n = 40_000  # half the rows are equal in id and text
    docs = spark.range(n).selectExpr(f"CASE WHEN id % 2 = 0 THEN {who} ELSE id END AS doc_id", "CASE WHEN id % 2 = 0 THEN 'the same' ELSE concat('text ', id) END AS text")
    found = [r for _, r in ranges(spark, docs, 6)]
    assert max(found) <= 2 * n / len(found)
    got = sharding.shard(docs, shards=6).toPandas()
    assert len(got) == n and got.groupby("shard")["size"].sum().pipe(lambda s: s.max() < 1.05 * s.min())
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_token_files_have_one_order_for_any_dealing(spark):
    rows = [(None, f"no id {k}") for k in range(40)] + [(3, f"repeated id {k}") for k in range(40)] + [(k, f"text {k}") for k in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def order(d):
        blocks, book = tokenid.write_ids(d, tokenid.vocabulary())
        return [(r.id, r.value) for r in sorted(tokenid.read_ids(blocks, book, lambda ids: ids.tolist(), "array<long>").collect(), key=lambda r: r.start)]

    first = order(docs)
    assert first == order(docs.repartition(7)) == order(docs.orderBy(F.desc("text")))
    assert [i for i, _ in first] == [None] * 40 + [3] * 40 + list(range(100, 140))


def test_word_pieces_give_the_library_ids(monkeypatch):
    """Random Unicode, special-token look-alikes, long pieces, cache turnover."""
    from lakeline.llm import wordpieces

    path = tokenid.vocabulary()
    rng = random.Random(4)
    alphabet = [*"abcXYZ019 .,!?;:$#&*%'\"-_/\\<>|[]()", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​", "é", "É", "é", "ß", "ẞ", "ä", "Ä", "İ", "ı",
                "ñ", "日", "本", "🙂", "Σ", "ς", "ﬁ", "Å", "Å", "́", "½", "٣", "<|endoftext|>", "<|ENDOFTEXT|>", "</s>", "[UNK]", "<s>", "<unk>", "the", "Ing"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(6000)]
    texts += ["x" * 5000, "Éa" * 3000, "ab" * 2000 + "!" * 100, "...", "a.b.c", "", " ", "\n\n"]
    wordpieces.encoder.cache_clear()
    monkeypatch.setattr(wordpieces, "REMEMBERED", 500)  # generations turn over many times
    own = encoder(path)
    assert own.by_piece
    got = []
    for lo in range(0, len(texts), 300):
        got += [np.frombuffer(b, own.dtype).tolist() for b in own(texts[lo:lo + 300])]
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    bad = [t for t, g, w in zip(texts, got, want, strict=True) if g != w]
    assert not bad, bad[:3]
    wordpieces.encoder.cache_clear()


def test_early_pieces_are_encoded_once_and_memory_is_bounded(monkeypatch):
    """Before, two turns of the memory forgot frequent pieces, to be encoded again."""
    from lakeline.llm import wordpieces

    monkeypatch.setattr(wordpieces, "REMEMBERED", 400)
    own, met = wordpieces._Encoder(tokenid.vocabulary()), Counter()
    library, model = own.tokenizer, own.tokenizer.model

    def tokenize(units):
        met[units] += 1
        return model.tokenize(units)

    own.model = SimpleNamespace(tokenize=tokenize)
    own.tokenizer = SimpleNamespace(model=own.model, encode_batch_fast=library.encode_batch_fast)
    letters = "abcdefghij"
    words = ["x" + "".join(letters[int(c)] for c in f"{k:05d}") for k in range(10000)]
    common = " ".join(words[:100])
    texts = [common, *(" ".join(words[k: k + 250]) + ", " + words[k] + "!?" for k in range(100, 9850, 250)), common]
    got = [np.frombuffer(own([t])[0], own.dtype).tolist() for t in texts]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert {met[w] for w in words[:100]} == {1}
    assert len(own.known) <= 400


def test_a_hot_url_takes_one_place_of_the_sample(spark):
    urls = spark.range(900).selectExpr("id AS page_id", """CASE WHEN id % 3 = 0 THEN 'http://hot.example.org/es/a' WHEN id % 3 = 1 THEN concat('http://h', id, '.org/p', id)
                                       ELSE concat('http://g', id, '.com/de/', id) END AS url""")
    rows = urlfilter.lexical(urlfilter.with_rule(urlfilter.parsed(urls, "page_id", "url"), urlfilter.RULES))
    labelled = rows.where("by_rule is not null").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    model = urlfilter.train(labelled, 0.6, most=400)
    assert model.getNumTrees > 0
    # All 300 copies of the hot url would fill most of 400 places: both labels are still learnt.
    judged = urlfilter.scored(rows, labelled, 400).where("by_rule is not null").select((F.col("guess") == F.col("by_rule")).alias("ok")).toPandas()
    assert judged.ok.mean() > 0.95


def test_revisits_and_times(spark):
    """Null times, and many earlier responses of one url to choose from."""
    rows = [(1, "http://a.com", None, "response", None, "d", None, "none"), (2, "http://a.com", 5, "revisit", None, "d", None, None), (3, "http://b.com", 1, "response", None, "d", None, "b1"),
            (4, "http://b.com", None, "revisit", None, "d", None, None)]
    for k in range(200):
        rows.append((1000 + k, "http://c.com", 10 * k, "response", f'"{k}"', None, {"k": str(k)}, f"c{k}"))
        rows.append((2000 + k, "http://C.com/", 10 * k + 5, "revisit", f'W/"{k - k % 2}"', None, None, None))
    got = {r.record_id: (r.status, r.refers_to, r.digest) for r in warc.resolve_revisits(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert got[2] == ("no_prior", None, None) and got[4] == ("no_prior", None, None)
    assert all(got[2000 + k] == (("resolved", 1000 + k, f"c{k}") if k % 2 == 0 else ("changed", None, None)) for k in range(200))


def test_ten_blocks_give_what_one_does_and_write_little(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(words, k=30))) for k in range(40)]
    texts = []
    for k in range(400):
        body = rng.choices(words, k=1500)
        if k % 20 == 0:
            for _ in range(3):
                piece = items[rng.randrange(40)][1].split()
                at = rng.randrange(len(body))
                body[at:at] = piece[:rng.randrange(8, 30)]
        texts.append((k, " ".join(body), "x"))
    texts += [texts[0]] * 3 + [(None, None, "n"), (900, "", "e"), (901, items[3][1], "i")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, h1 string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    written = []
    keep = decontaminate.written
    try:
        decontaminate.written = lambda df, name: written.append(keep(df, name)) or written[-1]
        one = decontaminate.decontaminate(docs, bench)
        many = decontaminate.decontaminate(docs, bench, block_words=120)
        cols = ["doc_id", "n_words", "n_hit", "items", "spans", "text"]
        assert sorted(map(str, many.select(cols).collect())) == sorted(map(str, one.select(cols).collect()))
        cut_one = decontaminate.remove_passages(docs, bench)
        cut_many = decontaminate.remove_passages(docs, bench, block_words=120)
        assert cut_many.columns == docs.columns and sorted(map(str, cut_many.collect())) == sorted(map(str, cut_one.collect()))
    finally:
        decontaminate.written = keep
    size = sum(len(t or "") for _, t, _ in texts)
    assert sum(len(str(r)) for df in written for r in df.collect()) < 0.3 * size  # hits, and the hit documents' cut texts


def test_mix_of_one_length_only(spark):
    """A budget far over the dynamic program's table: the rest goes by largest remainder."""
    rows = [(k, " ".join(["w"] * (100_000 if k < 40 else 3 + k % 50)), "ab"[k % 2]) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).toPandas()
    by = got.assign(source=["ab"[i % 2] for i in got.doc_id]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 3).all()

"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
columns, for every operator and pipeline stage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeline.llm import chat, components, decontaminate, linededup, mixing, quality, sharding, simhash, tokenid, urlfilter, warc

LONG = " ".join(f"w{k * k % 977}" for k in range(60_000))
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
# Columns named like ones that the operators make.
EXTRA = [f"'x' AS {c}" for c in ("id", "size", "n_words", "fp", "key", "slice", "range", "crc", "mark", "spans", "cut", "u", "v", "h1", "kept", "score")]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents of every odd kind; ids None and 3 repeat."""
    rows = [(0, None, "en", "a", None), (1, "", "en", "a", 0), (2, " \t\n ", None, None, 4), (3, f"one two {PASSAGE} three", "en", "b", 50),
            (3, f"one two {PASSAGE} three", "en", "b", 50), (None, "no id here but words enough to be a document of its own", "en", "b", 1),
            (None, None, None, None, None), (4, LONG, "de", "a", len(LONG)), (5, LONG, "de", "a", len(LONG)), (6, "A\nB\nC\nD\n\n", "en", "a", 9),
            (7, "x\nA\nB\nC \nD", "en", None, 9), (8, "\x00 \x1c é 日本 <|endoftext|> </s>", "fr", "b", 9), (9, PASSAGE, "en", "b", 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *EXTRA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (None, "tiny"), (3, ""), (10, "beta gamma")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 1, None), (None, 1, 0), (1, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")


def by_id(df, *cols):
    return sorted(([r["doc_id"], *(r[c] for c in cols)] for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r[1:])))


def test_decontaminate(odd, none, items):
    got = by_id(decontaminate.decontaminate(odd, items), "n_words", "n_hit", "items")
    assert [0, 0, 0, []] in got and [1, 0, 0, []] in got and len(got) == 13
    assert got.count([3, 15, 12, ["1", "10"]]) == 2 and [9, 12, 12, ["1", "10"]] in got
    # Blocks of a few words give what one automaton gives.
    blocks = by_id(decontaminate.decontaminate(odd, items, block_words=3), "n_words", "n_hit", "items")
    assert blocks == got
    assert decontaminate.decontaminate(none, items).count() == 0
    assert all(r["n_hit"] == 0 for r in decontaminate.decontaminate(odd, items.where("false")).collect())
    clean = decontaminate.remove_passages(odd, items, length_col="n_chars", max_coverage=0.85)
    assert clean.columns == odd.columns and dict(clean.dtypes) == dict(odd.dtypes)
    left = by_id(clean, "text", "n_chars")
    assert left.count([3, "one two  three", 14]) == 2 and not any(r[0] == 9 for r in left) and [0, None, None] in left
    assert decontaminate.remove_passages(none, items).count() == 0


def test_removal_does_not_depend_on_blocks(spark):
    items = spark.createDataFrame([("p", "a b c"), ("q", "c d e"), ("r", "k l m"), ("s", "x y z")], "item_id string, text string")
    rows = [(1, "a b c 1 2 3 4 k l m"),             # 30 % and 30 %: over half
            (2, "a b c 1 2 3 k l m 4 5 6 7"),       # 3 of 13 and 3 of 13; of the ten words left, 3 more
            (3, "1 2 3 4 a b c d e 5 6"),           # the items overlap
            (4, "1 2 3 4 a b x y z c 5 6 7 8 9"),   # the last item's cut joins the first one's words
            (5, "1 2 3 4 a k l x y z m b c 5 6 7 8 9 10 11 12"), (6, "clean"), (7, None), (2, "a b c 1 2 3 k l m 4 5 6 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("'x' AS id", "*", "'y' AS spans", "0 AS n_chars")
    want = [[2, "1 2 3 4 5 6 7"]] * 2 + [[3, "1 2 3 4 5 6"], [4, "1 2 3 4 5 6 7 8 9"], [5, "1 2 3 4 5 6 7 8 9 10 11 12"], [6, "clean"], [7, None]]
    for size in (3, 6, 100):
        out = decontaminate.remove_passages(docs, items, length_col="n_chars", window=3, block_words=size)
        got = by_id(out, "text", "n_chars")
        assert [[i, t and " ".join(t.split())] for i, t, _ in got] == want, size
        assert all(n == (None if t is None else len(t)) for _, t, n in got) and out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)


def test_spans_and_longest(odd, items):
    row = decontaminate.decontaminate(odd, items).where("doc_id = 3").first()
    assert [(s.first, s.last) for s in row.spans] == [(2, 13)] and row.longest == 12


def test_simhash(spark, odd, none):
    got = by_id(simhash.near_duplicates(odd), "fingerprint", "component_id")
    assert len(got) == 13
    zero = "0" * 16
    assert all(r[1:] == [zero, 0] for r in got if r[0] in (0, 1, 2)) and [None, zero, 0] in got
    assert {r[2] for r in got if r[0] in (4, 5)} == {4}
    kept = by_id(simhash.keep_one(odd), "text")
    assert simhash.keep_one(odd).columns == odd.columns
    ids = [r[0] for r in kept]
    assert ids.count(0) == 1 and ids.count(3) == 1 and 5 not in ids and 1 not in ids and ids.count(None) == 1  # the one without text is a copy of 0
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_dense_group_is_divided_without_losing_links(spark, monkeypatch):
    """Thousands of fingerprints that share most bits: keys are cut again and
    again, and the components are those of all pairs."""
    monkeypatch.setattr(simhash, "BUCKET", 16)
    rnd = random.Random(4)
    base = rnd.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rnd.sample(range(20), rnd.randint(0, 6))) for _ in range(700)} | {rnd.getrandbits(64) for _ in range(200)}
    arr = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in arr.view(np.int64)], "fp long")
    path = simhash.written(df, "test")
    got = {r.node: r.root for r in components.components(simhash.links(path)).collect()}
    up = list(range(len(arr)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(arr)):
        for y in np.flatnonzero(np.bitwise_count(arr ^ arr[x]) <= 3):
            up[top(int(y))] = top(x)
    signed = arr.view(np.int64)
    groups = {}
    for x in range(len(arr)):
        groups.setdefault(top(x), []).append(int(signed[x]))
    for g in groups.values():
        assert {got.get(x, x) for x in g} == {min(g)}


def test_thresholds_cover_every_pair():
    """Whatever the dynamic program picks, no linked pair is missed."""
    rnd = random.Random(9)
    blocks = [list(range(8 * k, 8 * k + 8)) for k in range(8)]
    for n in (10, 10**5, 10**7, 10**9):
        near = [simhash.block_distances(np.array([rnd.randint(0, 9) for _ in range(256)])) for _ in range(8)]
        parts = simhash.plan_parts(blocks, near, n)
        for _ in range(300):
            flip = rnd.sample(range(64), 3)
            assert any(sum(b in bits for b in flip) <= t for bits, t in parts)


def test_token_ids(odd, none, spark):
    from tokenizers import Tokenizer

    path = tokenid.vocabulary()
    tokenizer = Tokenizer.from_file(path)

    def read(docs):
        blocks, book = tokenid.write_ids(docs, path)
        return tokenid.read_ids(blocks, book, lambda ids: ids.tolist(), "array<long>").collect()

    got = read(odd)
    want = {(r.doc_id, r.text): [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in odd.collect()}
    assert sorted((r.id is None, r.id or 0, r.value) for r in got) == sorted((i is None, i or 0, want[i, t]) for i, t in [(r.doc_id, r.text) for r in odd.collect()])
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0, *(r.n_tokens for r in in_order[:-1])]).tolist()
    assert [r.id for r in in_order] == [None, None, 0, 1, 2, 3, 3, *range(4, 10)]
    assert read(none) == []


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rnd = random.Random(3)
    for n in (1, 2, 3, 17, 300):
        counts = {k * 3: rnd.randint(1, 10 ** rnd.randint(1, 6)) for k in range(n)}
        got = tokenid.code_lengths(counts, 64)
        heap = list(counts.values())
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a + b
            heapq.heappush(heap, a + b)
        assert sum(counts[k] * v for k, v in got.items()) == (cost or sum(counts.values()))
        limited = tokenid.code_lengths(counts, 10)
        assert max(limited.values()) <= max(10, (n - 1).bit_length()) and sum(2.0 ** -v for v in limited.values()) <= 1


def test_code_words_are_canonical():
    """By length, then by id; each the next after the one before."""
    rnd = random.Random(5)
    for n in (1, 2, 5, 300):
        lengths = tokenid.code_lengths({k * 3: rnd.randint(1, 10 ** rnd.randint(1, 6)) for k in range(n)})
        code, word, before = tokenid.Code(lengths), 0, 0
        for bits, i in sorted((v, k) for k, v in lengths.items()):
            word <<= bits - before
            before = bits
            assert code.length[i] == bits and int(code.top[i]) == word << (64 - bits)
            word += 1
        ids = np.array(rnd.choices(list(lengths), k=1000), np.uint32)
        assert code.decode(*code.encode(ids), len(ids)).tolist() == ids.tolist()


def test_quality(odd, none, labels):
    got = by_id(quality.quality(odd, labels), "n_words", "base_failed", "kept")
    assert len(got) == 13 and [0, 0, True, False] in got and [2, 0, True, False] in got
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and sorted(r[0] for r in by_id(kept, "text") if r[0]) == sorted(r[0] for r in got if r[3] and r[0])
    everything = by_id(quality.quality(odd, labels.where("false")), "base_failed", "kept")
    assert all(r[1] != r[2] for r in everything)
    assert quality.quality(none, labels).count() == 0 and quality.keep_good(none, labels).count() == 0


@pytest.mark.parametrize("n", [1, 2, 99, 100, 400])
def test_quality_bar_is_one_rule_at_every_size(spark, n):
    """The order statistic of the trusted documents' scores, each judged by the
    others; a repeated trusted id counts with its least score."""
    texts = [" ".join(f"w{k * (i + 3) % (i + 7)} x{i % 5}" for k in range(12)) for i in range(n)]
    rows = [*enumerate(texts), (None, texts[0]), (700, "other " * 30), (0, texts[-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "if(doc_id = 700, 1, 0) AS toxic")
    grams = [quality.gram_buckets(np.frombuffer(t.encode(), np.uint8)) for _, t in rows]
    count = [np.bincount(g, minlength=1 << 16) for g in grams]
    good = [i is not None and i != 700 for i, _ in rows]
    raw, target, half = sum(count), sum(c for c, k in zip(count, good, strict=True) if k), (1 << 16) / 2
    scores = []
    for g, c, k in zip(grams, count, good, strict=True):
        t, r = target - c * k, raw - c
        ratio = np.log((t[g] + 0.5) / (t.sum() + half)) - np.log((r[g] + 0.5) / (r.sum() + half))
        wide = min(quality.PASSAGE, len(g))
        scores.append(np.convolve(ratio, np.ones(wide) / wide, "valid").min())
    got = quality.quality(docs, labels).toPandas()
    failed = {t: f for (_, t), f in zip(rows, quality.base_failed(quality.measure(docs.select("text").toArrow().column(0).combine_chunks())), strict=True)}
    least = {}
    for (i, t), s, k in zip(rows, scores, good, strict=True):
        if k and not failed[t]:
            least[i] = min(least.get(i, np.inf), s)
    bar = sorted(least.values())[len(least) // 100] if least else -np.inf
    assert sorted(zip(got.base_failed, got.kept, strict=True)) == sorted((failed[t], not failed[t] and s >= bar - 1e-5) for (_, t), s in zip(rows, scores, strict=True))
    assert np.allclose(sorted(got.llr), sorted(scores), atol=1e-5)


def test_urls(spark):
    rows = [(1, "https://a.example.org/es/x?y=1"), (2, None), (3, "no scheme"), (4, "HTTP://ExAmple.ORG/en/12#f"), (4, "HTTP://ExAmple.ORG/en/12#f"), (None, "http://forg/"),
            (5, "http://org"), (6, "x://a.com/de/1"), (7, "http://b.com/fr/" + "9" * 50_000), (8, "http://?q=a://b")]
    urls = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS label", "'z' AS path")
    got = {r.page_id: (r.host, r.path[:8], r.rule, r.verdict) for r in urlfilter.filter_urls(urls).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block") and got[2][:3] == ("", "", None) == got[3][:3]
    assert got[4] == ("example.org", "/en/12", "example.org/en/1", "block") and got[None][2] is None and got[5][:3] == ("org", "", None)
    assert got[6][2:] == ("com/de/", "block") and got[7][2:] == ("com/fr/", "allow") and got[8][:3] == ("", "", None)
    assert {v[3] for v in got.values()} == {"allow", "block"} and urlfilter.filter_urls(urls).count() == len(rows)
    assert urlfilter.filter_urls(urls.where("false")).count() == 0
    assert {r.verdict for r in urlfilter.filter_urls(urls.where("page_id in (2, 3)")).collect()} == {"allow"}


def test_chat(spark):
    path = tokenid.vocabulary("byte_bpe_50k.json")
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, "</s>[INST] \\</s>\\"), (None, 5, "assistant", "a\n\r é日"), (None, None, "assistant", ""),
            (2, 0, "assistant", "<|endoftext|>" + "long [/INST] " * 5000), (2, 1, "assistant", "<s>")]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS ids", "1 AS start", "2 AS conv")
    made = simhash.written(chat.format_chat(talks, path), "chat")
    got = {r.conv: r for r in chat.read_chat(made, path).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, 2: 2, None: 2}
    said = "<|endoftext|>" + "long [/INST] " * 5000 + "<s>"
    import hashlib

    assert got[2].loss_chars == len(said) and got[2].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256("\n</s>[INST] \\</s>\\\nuser\n\nuser\n\n".encode()).hexdigest() or got[1].turns_sha256 == hashlib.sha256(
        "user\n\nuser\n\n\n</s>[INST] \\</s>\\\n".encode()).hexdigest()
    # Control ids stand at the marks alone, and places run on without gaps.
    marks = chat.reserved(path)
    for conv in (1, 2, None):
        own = sorted((r for r in made.collect() if r.conv == conv), key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0, *(len(r.ids) for r in own[:-1])]).tolist() and [r.opens for r in own] == [True] + [False] * (len(own) - 1)
        for r in own:
            assert [i for i in r.ids if i >= min(marks.values())] == [marks[c] for c in ((chat.BEGIN,) if r.opens else ()) + (chat.TURN, chat.SAYS, chat.END)]
    assert chat.read_chat(simhash.written(chat.format_chat(talks.where("false"), path), "chat"), path).count() == 0


def test_chat_conversation_over_many_slices(spark):
    import hashlib

    path = tokenid.vocabulary("byte_bpe_50k.json")
    turns = {7: 4000, 8: 3, None: 500}
    rows = [(c, k, ("user", "assistant")[k % 2], f"turn {k} </s>") for c, n in turns.items() for k in range(n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5), path).cache()
        own = sorted((r for r in made.collect() if r.conv == 7), key=lambda r: r.start)
        assert [r.turn for r in own] == list(range(4000)) and [r.opens for r in own] == [True] + [False] * 3999
        assert [r.start for r in own] == np.cumsum([0, *(len(r.ids) for r in own[:-1])]).tolist()
        got = {r.conv: r for r in chat.read_chat(made, path).collect()}
        # Rows of one conversation lie in many slices, and no task has them all.
        sizes = made.where("conv = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 2 and max(r["count"] for r in sizes) < 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {c: r.n_turns for c, r in got.items()} == turns
    for c, n in turns.items():
        mine = [r for r in rows if r[0] == c]
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in mine).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256("".join(r[3] for r in mine if r[2] == "assistant").encode()).hexdigest()


def test_shards(spark, odd, none):
    got = sharding.shard(odd, shards=3).collect()
    assert len(got) == 13 and all(r.size == 8 and r.text_crc32 == 0 for r in got if r.doc_id == 0)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard(none).count() == 0
    # One text holds a third of all rows: its range is cut by id.
    hot = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same text' ELSE concat('text ', id) END AS text")
    total = [r[1] for r in sharding.shard(hot, shards=6).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(total) == 6 and max(total) < 1.1 * min(total)


def test_lines(spark, odd, none):
    got = by_id(linededup.dedup_lines(odd), "text", "n_lines", "n_removed")
    assert len(got) == 13 and [0, None, 0, 0] in got and [1, "", 1, 0] in got
    assert [6, "A\nB\nC\nD\n\n", 6, 0] in got and [7, "x", 5, 4] in got  # two overlapping repeats
    assert linededup.dedup_lines(none).count() == 0
    own = spark.createDataFrame([(1, "\n".join("abc" * 3)), (2, "p\nq\n\nr\ns"), (3, "q\nr\ns\nt\np\nq\nr")], "doc_id long, text string")
    assert [r[1:] for r in by_id(linededup.dedup_lines(own), "text", "n_removed")] == [["a\nb\nc", 6], ["p\nq\n\nr\ns", 0], ["t", 6]]


def test_mix(odd, none):
    got = by_id(mixing.mix(odd), "size", "source_size", "target", "taken")
    assert len(got) == 13 and all(r[4] <= 2 * r[1] for r in got) and all(r[4] == 0 for r in got if r[1] == 0)
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns and mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    assert rows.where("text is null").count() == 0


def test_fit_reaches_what_can_be_reached():
    rnd = random.Random(8)
    for _ in range(300):
        size = np.array(sorted(rnd.sample(range(1, 40), rnd.randint(1, 5))))
        n = np.array([rnd.randint(1, 3) for _ in size])
        budget = rnd.uniform(0, 1.1 * float((size * n).sum()))
        took = mixing.fit(size, n, budget)
        assert (took >= 0).all() and (took <= n).all()
        free = n - np.minimum(np.floor(n * min(1, budget / (size * n).sum())), n).astype(int)
        sums = {0}
        for s, k in zip(size, free, strict=True):
            sums = {a + s * j for a in sums for j in range(k + 1)}
        fixed = float(((n - free) * size).sum())
        best = min(abs(fixed + a - budget) for a in sums)
        assert abs(float((took * size).sum()) - budget) <= best + 1


def test_revisits(spark):
    def rec(i, url, ts, kind, etag=None, lm=None, headers=None, digest=None):
        return (i, url, ts, kind, etag, lm, headers, digest)

    rows = [rec(1, "http://www.A.com:80/x/?b=2&utm_source=q&a=1#f", 10, "response", '"e"', "d", {"ETag": '"e"', "Content-Length": "5", "Date": "old"}, "p1"),
            rec(2, "https://a.com/x?a=1&b=2", 10, "revisit", '"e"'), rec(3, "https://a.com/x?a=1&b=2", 11, "revisit", 'W/"e"', "other", {"DATE": "new", "content-length": "0", "Date": "late"}),
            rec(4, "https://a.com/x?a=1&b=2", 12, "revisit", '"f"'), rec(5, "https://a.com/x?a=1&b=2", 12, "revisit", None, "d"), rec(6, "https://a.com/x?a=1&b=2", 12, "revisit"),
            rec(7, None, 5, "response", None, "d", None, "p7"), rec(8, "", 6, "revisit", None, "d"), rec(9, "http://b.com", 6, None, '"e"')]
    records = spark.createDataFrame(rows, warc.RECORD)
    got = {r.record_id: r for r in warc.resolve_revisits(records).collect()}
    assert {k: r.status for k, r in got.items()} == {2: "no_prior", 3: "resolved", 4: "changed", 5: "resolved", 6: "no_validator", 8: "resolved", 9: "no_prior"}
    assert got[3].headers == {"etag": '"e"', "content-length": "5", "date": "new"} and got[3].refers_to == 1 and got[8].headers == {} and got[8].digest == "p7"
    assert warc.resolve_revisits(records.where("false")).count() == 0
    # Null and repeated ids: each revisit row gives one row.
    rows = [rec(1, "http://c.com", 1, "response", '"e"', None, {"a": "1"}, "p1")] * 3 + [rec(2, "http://c.com", 2, "revisit", '"e"')] * 4 + \
        [rec(None, "http://d.com", 1, "response", '"n"', None, {"b": "2"}, "pn")] * 2 + [rec(None, "http://d.com", 2, "revisit", '"n"')] * 2 + \
        [rec(None, "http://c.com", 3, "revisit", '"e"'), rec(1, "http://e.com", 1, "response", '"e"', None, {"a": "3"}, "p3"), rec(2, "http://e.com", 2, "revisit", '"f"')] + \
        [rec(None, "http://f.com", None, "response", None, None, None, "pf"), rec(None, "http://f.com", None, "revisit")]
    got = warc.resolve_revisits(spark.createDataFrame(rows, warc.RECORD)).collect()
    found = sorted([str(r.record_id), r.curl, r.status, str(r.refers_to), str(r.digest), str(r.headers)] for r in got)
    assert found == sorted([["2", "c.com", "resolved", "1", "p1", "{'a': '1'}"]] * 4 + [["None", "d.com", "resolved", "None", "pn", "{'b': '2'}"]] * 2 +
                           [["None", "c.com", "resolved", "1", "p1", "{'a': '1'}"], ["2", "e.com", "changed", "None", "None", "None"], ["None", "f.com", "no_prior", "None", "None", "None"]])
    # A url with a third of all records, over many slices.
    n = 3000
    many = spark.range(n).selectExpr("id AS record_id", "CASE WHEN id % 3 = 0 THEN 'http://hot.com' ELSE concat('http://h', id % 50) END AS url", "id AS ts",
                                     "CASE WHEN id % 7 = 0 THEN 'response' ELSE 'revisit' END AS kind", "CASE WHEN id % 2 = 0 THEN 't' END AS etag", "'d' AS last_modified",
                                     "cast(NULL AS map<string,string>) AS headers", "cast(id AS string) AS digest")
    last, want = {}, {}
    for i in range(n):
        url = "hot" if i % 3 == 0 else i % 50
        if i % 7 == 0:
            last[url] = i
        else:
            want[i] = last.get(url)
    found = {r.record_id: r.refers_to if r.status == "resolved" else None for r in warc.resolve_revisits(many).collect()}
    assert found == {i: (p if p is not None and (i % 2 or p % 2 == 0) else None) for i, p in want.items()}


def test_pipeline_stages_on_odd_tables(spark, odd, none, items, labels, tmp_path):
    import corpus_pipeline

    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == odd.columns or name == "tokens"
            out.count()


def stage_rows(spark, rows, *extra):
    """Documents of (doc_id, text, source), beside columns named like helpers of the stages."""
    names = ["_row", "_own", "_copy", "_times", "_id", "_", "tie", "none", "mark", "n", "rest", "times", "source_", "nowhere", "least", "root", "row"]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", *[f"concat('{n}', coalesce(doc_id, -1), source) AS `{n}`" for n in names], *extra)


def whole(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


WORDS = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcdefgh"]


def test_simhash_stage_keeps_one_row_of_each_group(spark):
    copy = WORDS[1] + " tail"
    rows = [(1, WORDS[0], "s"), (1, WORDS[2], "s"),              # unrelated texts under one id: both stay
            (None, WORDS[3], "s"), (None, WORDS[3], "s"),        # copies without an id: one stays
            (None, WORDS[4], "s"), (9, WORDS[4], "s"),           # the one with an id stays
            (7, WORDS[1], "s"), (5, WORDS[1], "t"),              # the least id stays
            (6, WORDS[5], "s"), (6, WORDS[5], "a"), (6, WORDS[5], "s"),  # equal in id and text: one of them, with its own columns
            (None, None, "s"), (20, "", "s")]                    # no text is the empty text
    docs = stage_rows(spark, rows)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    found = whole(got)
    every = whole(docs)
    assert all(r in every for r in found)
    assert sorted((str(r[0]), r[1]) for r in found) == sorted([("1", WORDS[0]), ("1", WORDS[2]), ("None", WORDS[3]), ("9", WORDS[4]), ("5", WORDS[1]), ("6", WORDS[5]), ("20", "")])
    assert whole(simhash.keep_one(docs.repartition(5))) == found and copy not in [r[1] for r in found]
    assert simhash.keep_one(docs.where("false")).count() == 0


def test_mixing_stage_takes_what_the_mix_decides(spark):
    rows = [(1, WORDS[0], "a"), (1, WORDS[0], "b"), (1, WORDS[0], "b"), (None, WORDS[1], "a"), (None, WORDS[1], None), (3, WORDS[2], "c"), (4, None, "c"), (5, "", "a")]
    rows += [(k, WORDS[k % 8] + f" {k}", "abc"[k % 3]) for k in range(10, 60)]
    docs = stage_rows(spark, rows)
    taken = mixing._taken(docs, "doc_id", "text", "source", mixing.SEED).collect()
    want = {}
    for r in taken:
        want.setdefault((r.id, r.source, r.mark), set()).add(r.times)
    assert all(len(t) == 1 for t in want.values())
    marks = {r[0]: r[1] for r in docs.select("text", F.xxhash64("text")).collect()}
    expected = sorted((tuple(r) for r in docs.collect() for _ in range(next(iter(want[(r.doc_id, r.source, marks[r.text])])))), key=str)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and whole(got) == expected


def test_passages_are_cut_beside_clashing_columns(spark, items):
    docs = stage_rows(spark, [(1, f"x {PASSAGE} y " + WORDS[0], "s"), (2, WORDS[1], "s"), (2, PASSAGE, "s")])
    one = decontaminate.remove_passages(docs, items)
    many = decontaminate.remove_passages(docs, items, block_words=3)
    assert whole(one) == whole(many) and len(whole(one)) == 2
    assert [r[2:] for r in whole(one)] == [r[2:] for r in whole(docs.where("doc_id = 1 or text like 'b%'"))]


def test_every_document_labelled_good_is_trusted(spark):
    """More than 20,000 of them: none is left out of the target."""
    n = 20_500
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "CAST(0 AS INT) AS toxic")
    trusted = quality.trusted_ids(labels.union(labels.limit(5)), "doc_id", quality._good())
    docs = spark.range(n + 10).selectExpr("id AS doc_id", "if(id < 20500, 'abcdefg', 'hijk') AS text")
    counts = quality.ngram_counts(docs, "doc_id", "text", trusted).selectExpr("sum(target)", "sum(raw)").first()
    assert tuple(counts) == (4 * n, 4 * n + 10)


def test_trusted_ids_too_many_to_broadcast_give_the_same_verdicts(odd, labels, spark, monkeypatch):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = quality.quality(odd, labels)
        assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" not in plan(few)  # no text moves
        one = sorted(map(str, few.collect()))
        monkeypatch.setattr(quality, "BROADCAST_IDS", -1)
        many = quality.quality(odd, labels)
        assert "SortMergeJoin" in plan(many) and sorted(map(str, many.collect())) == one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""Whitening, hard negatives and edit fingerprints: against numpy and brute
force at sf0.01, and on odd tables."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeline.llm import editprint, negatives, whitening
from lakeline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
EXTRA = [f"'x' AS {c}" for c in ("id", "x", "v", "n", "component", "slice", "part", "copy", "tie", "mark", "to", "next_text", "entries", "again", "key", "anchor", "same")]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", *EXTRA)


def checked(found: pd.DataFrame, x: np.ndarray, ids: list, components: int):
    """The whole result against numpy; ``x``: whole numbers."""
    n = len(x)
    mean = x.sum(0) / n
    cov = (x - mean).T @ (x - mean) / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    wide = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids]
    assert wide.shape == (n, components)
    want = (x - mean) @ q[:, :components] / np.sqrt(e[:components])
    for k in range(components):
        got = wide[k + 1].to_numpy()
        assert min(np.abs(got - want[:, k]).max(), np.abs(got + want[:, k]).max()) < 1e-7
    share = found.drop_duplicates("component").set_index("component").explained
    assert np.allclose(share.loc[range(1, components + 1)], e[:components] / e.sum(), rtol=1e-9)
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, x.sum(0), strict=True)) for r in x]
    assert found.drop_duplicates("vec_id").set_index("vec_id").deviation.loc[ids].astype(object).map(int).tolist() == exact
    assert (found.n == n).all() and found.identity_error.nunique() == 1 and 0 <= found.identity_error.iloc[0] < 1e-9


def test_whiten_matches_numpy(spark):
    raw = pd.read_parquet(f"{SF}/embeddings.parquet")
    x = np.floor(64 * np.stack(raw.embedding).astype(np.float64)).astype(np.int64) + 1_000_000
    checked(QUERIES["op11_whiten"](spark, SF).toPandas(), x, raw.vec_id.tolist(), 32)


def test_whiten_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(v) for v in rng.normal(size=3) * (1, 50, 1e6)], 0) for i in range(40)]
    bad = [(100, None, 0), (101, [1.0, None, 2.0], 0), (102, [1.0, float("nan"), 2.0], 0), (103, [1.0, float("inf"), 2.0], 0), (104, [], 0), (105, [1.0], 0)]
    got = whitening.whiten(vectors(spark, good + bad)).toPandas()
    x = np.floor(64 * np.array([g[1] for g in good], np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    checked(got, x, list(range(40)), 3)
    # Repeated rows and null ids count as rows; a direction without variance has no component.
    flat = [(None, [1.0, 2.0], 1)] * 3 + [(7, [3.0, 2.0], None)]
    got = whitening.whiten(vectors(spark, flat)).toPandas()
    assert got.component.tolist() == [1] * 4 and got.explained.tolist() == [1.0] * 4 and got.vec_id.isna().sum() == 3
    assert sorted(np.abs(got.whitened).round(9)) == sorted([round(1 / math.sqrt(3), 9)] * 3 + [round(math.sqrt(3), 9)])
    for none in (vectors(spark, []), vectors(spark, bad[:4]), vectors(spark, good[:1]), vectors(spark, good[:1] * 5)):
        out = whitening.whiten(none)
        assert out.count() == 0 and out.columns[0] == "vec_id"
    # Entries at the end of the range of whole numbers do no harm: beside them the others have no variance.
    assert whitening.whiten(vectors(spark, good + [(200, [3e38, -3e38, 0.0], 0)])).count() == 41


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 2, 2, 1], [1, 1 - 1e-9, 1 - 2e-9, 0.5], [1e12, 1, 1e-3], [1, 0, 0, 0], [2.0] * 9, list(range(1, 101))])
def test_slicing_finds_eigenvalues_close_and_multiple(values):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0]
    a = (q * np.array(values)) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.leading(a, n)
    want = np.array(sorted(values, reverse=True), float)
    want = want[want > 1e-9 * want[0]]
    e, v = e[:len(want)], v[:, :len(want)]
    assert np.allclose(e, want[:len(e)], rtol=1e-9, atol=1e-12 * want[0]) and len(e) == len(want)
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-8
    assert np.abs(a @ v - v * e).max() < 1e-12 * n * want[0]
    assert whitening.leading(np.zeros((3, 3)), 3)[0].size == 0


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 20):
        a = rng.normal(size=(n, n))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for s in [*(e[:-1] + e[1:]) / 2, e[0] - 1, e[-1] + 1]:
            f = whitening.Factors(a, s, 1e-30)
            assert f.negative == (e < s).sum()
            assert np.allclose((a - s * np.eye(n)) @ f.solve(np.ones(n)), 1, atol=1e-6)


def test_exact_products():
    z = np.array([[1 << 60, -(1 << 59) - 12345], [3, -7], [-(1 << 41) + 5, 1 << 20]], np.int64)
    o = z.astype(object)
    assert (whitening._products(z) == o.T @ o).all()


# --- hard negatives ---------------------------------------------------------

def plain_negatives(rows, anchors, positives=5, negatives_=10, low=30, high=90):
    """Result rows by sorting every anchor's pairs; rows: (id, label, x)."""
    out = []
    for a, al, ax in (r for r in rows if anchors(r[0])):
        pairs = sorted((-sum(int(p) * int(q) for p, q in zip(ax, x, strict=True)), i, lab) for i, lab, x in rows if i != a)
        for s, p, _ in [q for q in pairs if q[2] == al][:positives]:
            fit = [(t, i) for t, i, lab in pairs if lab != al and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, k, i, -s, -t) for k, (t, i) in enumerate(fit[:negatives_], 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.collect())


def test_negatives_match_brute_force(spark):
    raw = pd.read_parquet(f"{SF}/embeddings.parquet")
    label = np.where(raw.vec_id % 7 == 0, (raw.label + 1) % 10, raw.label)
    x = np.floor(256 * np.stack(raw.embedding).astype(np.float64)).astype(np.int64)
    got = QUERIES["op12_hard_negatives"](spark, SF)
    assert mined(got) == plain_negatives(list(zip(raw.vec_id.tolist(), label.tolist(), x, strict=True)), lambda i: i % 100 == 0)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}


@pytest.mark.parametrize("block", [1024, 2])
def test_negatives_with_ties_zeros_and_repeats(spark, block):
    rng = np.random.default_rng(5)
    # Small whole entries: many equal scores, zero scores and negative ones.
    data = [(i, [float(v) / 256 for v in rng.integers(-2, 3, 3)], int(rng.integers(0, 3))) for i in range(300)]
    data += [data[30]] * 4 + [(500, [1 / 256, 0.0, 0.0], 0), (500, [1 / 256, 0.0, 0.0], 0), (501, [0.0, 1 / 256, 0.0], 0)]
    bad = [(None, [1.0, 1.0, 1.0], 1), (600, None, 1), (700, [1.0, None, 1.0], 1), (800, [float("nan")] * 3, 1), (900, [1.0, 1.0, 1.0], None), (1000, [1.0], 1), (1100, [], 2)]
    got = negatives.mine(vectors(spark, data + bad).repartition(7), F.col("id") % 50 == 0, block=block)
    rows = [(i, lab, [round(256 * c) for c in v]) for i, v, lab in data]
    assert mined(got) == plain_negatives(rows, lambda i: i % 50 == 0)
    wide = negatives.mine(vectors(spark, data), F.col("id") % 50 == 0, positives=200, negatives=3, low=0, high=99)
    assert mined(wide) == plain_negatives(rows, lambda i: i % 50 == 0, 200, 3, 0, 99)
    assert negatives.mine(vectors(spark, []), F.col("id") % 50 == 0).count() == 0
    assert negatives.mine(vectors(spark, bad), F.col("id") % 50 == 0).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(vectors(spark, data), F.lit(True), high=100)


def test_negatives_with_a_hot_vector_and_wide_entries(spark):
    n = 3000
    hot = spark.range(n).selectExpr("id AS vec_id", "CASE WHEN id % 3 = 0 THEN array(1000000.0F, -3.0F) ELSE array(cast(id % 11 AS float), 2.0F) END AS embedding",
                                    "cast(id % 5 AS int) AS label")
    rows = [(i, i % 5, [256_000_000, -768] if i % 3 == 0 else [256 * (i % 11), 512]) for i in range(n)]
    assert mined(negatives.mine(hot.repartition(9), F.col("id") % 500 == 0)) == plain_negatives(rows, lambda i: i % 500 == 0)


# --- edit fingerprints ------------------------------------------------------

def order_minhash(spark, texts, k, chosen, orders):
    """Signatures by sorting all occurrence-numbered k-mers for every order;
    Spark gives the hashes only."""
    import re

    def hashes(values):
        rows = spark.createDataFrame([(i, list(v)) for i, v in enumerate(values)], "i int, v array<bigint>")
        as_columns = {len(v) for v in values}
        got = {}
        for n in as_columns:
            cols = [F.get("v", j) for j in range(n)]
            got |= {r[0]: r[1] for r in rows.where(F.size("v") == n).select("i", F.xxhash64(*cols) if n else F.xxhash64("v")).collect()}
        return [got[i] for i in range(len(values))]

    pieces = [re.findall(r"[^\x20\x09-\x0D]{1,16}", t) for t in texts]
    flat = sorted({p for ps in pieces for p in ps})
    of = {r[0]: r[1] for r in spark.createDataFrame([(p,) for p in flat], "p string").select("p", F.xxhash64("p")).collect()}
    out = []
    for ps in pieces:
        a = [of[p] for p in ps]
        grams = [a[i:i + k] for i in range(len(a) - k + 1)] if len(a) >= k else [a] if a else []
        found = hashes(grams) if grams else []
        top = [(h % 2**64) >> (64 - 35) for h in found]
        seen, numbered = {}, []
        for i, h in enumerate(top):
            numbered.append([h, seen.get(h, 0)])
            seen[h] = numbered[-1][1] + 1
        if numbered:
            # xxhash64(bigint, int)
            rows = spark.createDataFrame([(i, h, c) for i, (h, c) in enumerate(numbered)], "i int, h long, c int").select("i", F.xxhash64("h", "c")).collect()
            rank = [(v % 2**64) >> (64 - 35) for _, v in sorted(map(tuple, rows))]
        entries = []
        for j in range(orders):
            probe = math.floor(j * 2.0 ** 35 / orders)
            order = sorted(range(len(found)), key=lambda i: ((rank[i] - probe) % 2**35, i))[:chosen]
            entries.append([found[i] for i in sorted(order)])
        tuples = spark.createDataFrame([(j, e) for j, e in enumerate(entries)], "j int, e array<bigint>").select("j", F.xxhash64("e")).collect()
        out.append([v % 2**32 for _, v in sorted(map(tuple, tuples))])
    return out


@pytest.mark.parametrize("k,chosen,orders", [(2, 2, 64), (3, 3, 16), (1, 1, 8)])
def test_signatures_match_brute_force(spark, k, chosen, orders):
    texts = ["a b c d e f g h i j", "a a a a a a", "one", "", " \t ", "x y", "é 日本 🙂 " * 20, "b a " * 30 + "c", "w" * 100, " ".join(str(i * i % 37) for i in range(200))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", editprint.signature(F.col("t"), k, chosen, orders).alias("s"))
    got = [s for _, s in sorted(map(tuple, rows.collect()))]
    assert got == order_minhash(spark, texts, k, chosen, orders)


def expected_edits(ids_texts):
    """Edited text and next place of each row, in the order of the rows."""
    out = []
    for j, (_, t) in enumerate(ids_texts):
        nxt = ids_texts[(j + 1) % len(ids_texts)][1]
        half = len(t) // 2
        out.append(t[:len(t) - half] + nxt[:half])
    return out


def test_edit_prints_on_all_documents(spark):
    got = QUERIES["op13_edit_prints"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)
    docs["text"] = docs.text.fillna("")
    assert got.doc_id.tolist() == docs.doc_id.tolist() and got.n_chars.tolist() == docs.text.map(len).tolist()
    edits = expected_edits(list(zip(docs.doc_id, docs.text, strict=True)))
    assert got.edited_sha256.tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in edits]
    alone = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(zip(docs.text, edits, strict=True))], "i int, t string, e string")
    sign = {r[0]: r[1:] for r in alone.select("i", editprint.as_text(editprint.signature(F.col("t"))), editprint.as_text(editprint.signature(F.col("e")))).collect()}
    assert got.fingerprint.tolist() == [sign[i][0] for i in range(len(got))] and got.edited_fingerprint.tolist() == [sign[i][1] for i in range(len(got))]

    def like(a, b):
        return sum(a[k:k + 8] == b[k:k + 8] for k in range(0, len(a), 8)) / (len(a) // 8)

    assert got.near_edited.tolist() == [like(a, b) for a, b in zip(got.fingerprint, got.edited_fingerprint, strict=True)]
    nxt = [*got.fingerprint[1:], got.fingerprint[0]]
    assert got.near_next.tolist() == [like(a, b) for a, b in zip(got.fingerprint, nxt, strict=True)]
    # Equal texts, and only these, have equal fingerprints here; half a text kept is nearer than another text.
    assert got.fingerprint.groupby(docs.text).nunique().max() == 1
    assert (got.near_edited > got.near_next).mean() > 0.95 and 0.05 < got.near_edited.mean() < 0.3 and got.near_next.mean() < 0.01


def test_likeness_falls_with_edits_and_order(spark):
    words = [f"w{i}" for i in range(300)]
    turned = words[150:] + words[:150]
    forms = {"same": words, "one": [*words[:100], "new", *words[101:]], "ten": [w if i % 30 else "new" + w for i, w in enumerate(words)],
             "half": words[:150] + [f"v{i}" for i in range(150)], "turned": turned, "other": [f"z{i}" for i in range(300)]}
    rows = spark.createDataFrame([(k, " ".join(v), " ".join(words)) for k, v in forms.items()], "k string, a string, b string")
    near = dict(rows.select("k", editprint.likeness(editprint.signature(F.col("a"), orders=256), editprint.signature(F.col("b"), orders=256))).collect())
    assert near["same"] == 1 > near["one"] > near["ten"] > near["half"] > near["other"] == 0
    # Exchanged halves keep all but one k-mer; a set MinHash would call them equal.
    assert 0.3 < near["turned"] < 0.7


def test_edit_prints_odd_rows(spark):
    long = " ".join(f"w{k * k % 977}" for k in range(60_000))
    rows = [(None, None), (None, "no id"), (None, "no id"), (1, "one"), (1, "two words"), (1, "one"), (2, ""), (3, long), (-5, "é日🙂 x"), (9, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *EXTRA)
    got = editprint.edited(docs).collect()
    mark = {r.t: r.m for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("m")).collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, mark[r[1]]))
    want = sorted((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()) for (i, t), e in zip(order, expected_edits(order), strict=True))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want
    assert editprint.edited(docs.where("false")).count() == 0
    one = editprint.edited(docs.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"q").hexdigest()


def test_edit_prints_deal_out_copies_of_a_row(spark):
    """A third of all rows equal in id and text: dealt over several slices, and
    but one of them is followed by a copy."""
    n = 60_000
    docs = spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 30000 ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'ab cd' ELSE concat('t', id) END AS text")
    rows = docs.select(F.col("doc_id").alias("tie"), F.xxhash64("text").alias("mark"), "text")
    assert max(c for *_, c in editprint._splitters(rows)) > 1
    got = editprint.with_next(rows, ["text"])
    assert got.count() == n
    counts = {(r[0], r[1]): r[2] for r in got.groupBy("text", "next_text").count().where("text = 'ab cd' or next_text = 'ab cd'").collect()}
    assert counts[("ab cd", "ab cd")] == n // 3 - 1 and len(counts) == 3 and sorted(counts.values())[:2] == [1, 1]
    ids = [i for i in range(n) if i % 3]
    assert dict(got.where("text <> 'ab cd' and next_text <> 'ab cd'").select("text", "next_text").collect()) == \
        {f"t{a}": f"t{b}" for a, b in zip(ids, [*ids[1:], ids[0]], strict=True) if not a < 30000 <= b}

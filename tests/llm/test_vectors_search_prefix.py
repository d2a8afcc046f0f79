"""Whitening, ball-tree search and prefix BPE against brute force, their libraries and their edge cases."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from churnlake.llm import ball_search, prefix_bpe, queries, whitening
from tests.conftest import SF_SMALL
from tests.llm.test_llm import LONG, odd  # noqa: F401

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.Encoder(prefix_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


# ----------------------------------------------------------------------------- whitening


def solved(y, count=64):
    r = np.linalg.qr(y, mode="r")
    return whitening.principal(np.vstack([r, np.zeros((y.shape[1] - len(r), y.shape[1]))]), len(y), count)


@pytest.mark.parametrize("kind", ["plain", "graded", "tied", "few rows", "constant and repeated columns", "whole numbers"])
def test_qd_solver_against_lapack(kind):
    rng = np.random.default_rng(3)
    y = {
        "plain": lambda: rng.normal(size=(300, 40)),
        "graded": lambda: rng.normal(size=(300, 40)) * np.logspace(0, -6, 40),
        "tied": lambda: np.repeat(np.eye(20), 5, axis=0),
        "few rows": lambda: rng.normal(size=(9, 40)),
        "constant and repeated columns": lambda: np.column_stack([a := rng.normal(size=(100, 6)), np.ones(100), a[:, 0]]),
        "whole numbers": lambda: rng.integers(0, 2, size=(200, 30)).astype(float),
    }[kind]()
    y = y - y.mean(axis=0)
    e, v, total = solved(y)
    want = np.linalg.svd(y, compute_uv=False) ** 2 / len(y)
    rank = int((want > want[0] * 1e-26).sum())
    assert len(e) == rank and np.allclose(e, want[:rank], rtol=1e-10, atol=0) and np.isclose(total, want.sum())
    assert np.abs(v.T @ v - np.eye(rank)).max() < 1e-12
    w = y @ v / np.sqrt(e)
    assert np.abs(w.T @ w / len(y) - np.eye(rank)).max() < 1e-6


def test_dqds_keeps_tiny_values_accurate():
    # A graded bidiagonal whose smallest singular values a covariance in doubles would lose: the product of all is known exactly.
    a, b = np.logspace(0, -15, 16), np.logspace(0, -15, 16)[:-1] * 0.5
    got = whitening.dqds(a, b)
    assert np.isclose(np.log(got).sum(), 2 * np.log(a).sum(), rtol=1e-13)
    assert np.isclose(got.sum(), (a**2).sum() + (b**2).sum(), rtol=1e-14)


def test_whitening_against_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    out = queries.op11_embedding_whitening(spark, SF_SMALL).toPandas()
    rows = [(r["vec_id"], r["embedding"]) for r in emb.collect() if r["embedding"] and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    x = np.floor(64 * np.array([v for _, v in rows], dtype=float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov((x - s / n).T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(32, int((values > values[0] * 1e-20).sum()))
    assert len(out) == n * k and set(out["n"]) == {n} and (out["identity_error"] < 1e-9).all()
    white = out.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    assert np.allclose(np.abs(white), np.abs((x - s / n) @ vectors[:, :k] / np.sqrt(values[:k])), atol=1e-7)
    assert np.allclose(out.groupby("component")["explained"].first(), values[:k] / values.sum(), rtol=1e-9)
    assert out.groupby("vec_id")["deviation"].first().loc[[i for i, _ in rows]].tolist() == ((n * x - s) ** 2).sum(axis=1).tolist()


def test_whitening_of_odd_rows(spark):
    bad = [(2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0]), (8, [1e300, 0.0])]
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (9, [0.25, -7.5])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in bad + good], "vec_id long, embedding array<double>, whitened string, x int")
    out = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in out) == {1: 4, None: 2, 9: 2} and {r["n"] for r in out} == {4}
    one = df.where("vec_id = 1")
    assert whitening.whiten(one).count() == 0 and whitening.whiten(df.limit(0)).count() == 0  # no variance, no rows
    huge = spark.createDataFrame([(1, [3e9]), (2, [-3e9]), (3, [0.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} == {None, 0}


def test_triangles_are_reduced_in_groups(spark):
    df = spark.range(400).repartition(40).selectExpr("id AS vec_id", "transform(sequence(1, 6), k -> cast(xxhash64(id, k) % 1000 AS double) / 64) AS embedding")
    out = whitening.whiten(df, 6).toPandas()
    white = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(white.T @ white / 400 - np.eye(6)).max() < 1e-10


# ----------------------------------------------------------------------------- search


def ranked(docs, items, k=10):
    """Brute force: (item, rank, id, score)."""
    bags = [(i, Counter(ball_search.terms(t))) for i, t in docs]
    n = {k: sum(c.values()) for k, (_, c) in enumerate(bags)}
    total, words, df = sum(x > 0 for x in n.values()), sum(n.values()), Counter(t for _, c in bags for t in c)
    out = []
    for item, text in {(a, b) for a, b in items if b is not None}:
        found = []
        for row, (i, c) in enumerate(bags):
            m = 10 + 90 * n[row] * total // words
            score = sum(ball_search.term_weight(total, df[t]) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(ball_search.terms(text)) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def test_search_against_brute_force(spark, odd):  # noqa: F811
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], asked)
    for at_once in (256, 7):  # in one pass and in several
        assert sorted(map(tuple, ball_search.search(docs, items, items_at_once=at_once).collect()), key=str) == want
    strange = spark.createDataFrame([(1, "same text, HERE", "x"), (1, "same text, HERE", "y"), (2, None, "z"), (None, "the fox!", "z"), (3, "", "z"), (4, "Ärger ärger naïve", "z"), (5, "the fox!", "z"), (4, "nowhere", "z")], "item_id long, text string, rank string")
    got = sorted(map(tuple, ball_search.search(odd, strange, k=3).collect()), key=str)
    assert got == ranked([(r["doc_id"], r["text"]) for r in odd.collect()], [(r["item_id"], r["text"]) for r in strange.collect()], 3)
    assert ball_search.search(odd.limit(0), items).count() == 0 and ball_search.search(odd, items.limit(0)).count() == 0


def test_terms():
    assert ball_search.terms("A-b_c\x7fÄé1 x y\t") == [t.encode() for t in ["a", "b", "c", "Äé1", "x", "y"]]
    assert ball_search.terms("a\u00a0b") == ["a\u00a0b".encode()]  # beyond ASCII everything belongs to a term
    assert ball_search.terms(None) == ball_search.terms(" .;") == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    # Documents of 4 subjects; items ask for one subject's words: subtrees of other subjects need not be opened.
    dims, docs = 400, 3000
    subject = rng.integers(0, 4, docs)
    held = [np.unique(rng.integers(0, 100, 6) + 100 * s) for s in subject]
    lengths = np.array([len(h) for h in held])
    impact = rng.integers(400_000, 900_000, lengths.sum())
    weights = np.zeros((20, dims), np.int64)
    for q in range(20):
        weights[q, 20 * q : 20 * q + 20] = rng.integers(1000, 9000, 20)
    tree = ball_search.BallTree(np.concatenate([[0], np.cumsum(lengths)]), np.concatenate(held), impact, ball_search.Queries(weights))
    dense = np.zeros((docs, dims), np.int64)
    dense[np.repeat(np.arange(docs), lengths), np.concatenate(held)] = impact
    scores = dense @ weights.T
    for k, (a, b) in enumerate(tree.runs):
        assert (tree.bounds[k] >= scores[tree.order[a:b]].max(axis=0)).all()
    best = [ball_search.Best(10) for _ in range(20)]
    opened = ball_search.search_block(tree, list(range(docs)), best)
    for q in range(20):
        order = np.lexsort((np.arange(docs), -scores[:, q]))[:10]
        assert [(-r[0], r[3]) for r in best[q].rows] == [(int(scores[j, q]), int(j)) for j in order]
    assert opened < 0.5 * 20 * (len(tree.runs) - tree.first_leaf)


def test_equal_copies_beyond_a_leaf_come_by_id(spark):
    docs = spark.createDataFrame([(i, "wanted words here") for i in range(500, 0, -1)] + [(1000 + i, "other things") for i in range(700)], "doc_id long, text string")
    got = ball_search.search(docs, spark.createDataFrame([(7, "wanted")], "item_id long, text string")).collect()
    assert sorted((r["rank"], r["doc_id"]) for r in got) == [(k, k) for k in range(1, 11)]


# ----------------------------------------------------------------------------- prefix BPE


def random_texts(rng, pieces, n):
    letters = [chr(c) for c in [*range(0x180), *range(0x400, 0x460), *range(0x3040, 0x30A0), *range(0x4E00, 0x4E80), 0x1F600, 0x2028, 0x3000]]
    makers = [lambda: rng.choice(letters), lambda: rng.choice(pieces), lambda: rng.choice("ab a\n' "), lambda: rng.choice("aeinstr")]
    for k in range(n):
        yield "".join(makers[k % 4]() for _ in range(rng.randrange(70)))


def test_prefix_tokens_equal_the_library(spark, encoder, library):
    docs = [r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    texts = docs + list(random_texts(random.Random(1), [p.decode("utf-8", "ignore") for p in encoder.pieces], 4000)) + ["", "x" * 50_000, "漢字" * 5000, "<|endoftext|>"]
    for text, packed in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert encoder.decode(packed) == text.encode()


def test_known_words_change_generations(encoder, library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "CACHED_WORDS", 50)
    monkeypatch.setattr(prefix_bpe, "CACHED_PAIRS", 50)
    texts = list(random_texts(random.Random(2), ["qu", "ick", " fox"], 200))
    for at in range(0, 200, 20):
        for text, packed in zip(texts[at : at + 20], encoder.encode(texts[at : at + 20])):
            assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)


def test_words_that_merging_never_reaches(encoder):
    # "abc" is a token, but "bc" merges first and "a" + "bc" gives it too late: only the whole word is that token.
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"cd": 257, b"ab": 258, b"abcd": 259}
    own = tiktoken.Encoding("tiny", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = [prefix_bpe.merged(p, ranks, r) for p, r in ranks.items()]
    made = prefix_bpe.Ranks(list(ranks), [ranks[p[0]] if len(p) == 2 else -1 for p in parts], [ranks[p[1]] if len(p) == 2 else -1 for p in parts], [len(p) < 3 for p in parts])
    e = prefix_bpe.Encoder(made, public_tokenizers.PATTERN)
    for text in ("abcd", "abcde", "xabcd", "abcdabcd", "bcd cd ab"):
        assert np.frombuffer(e.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)
        assert prefix_bpe.PrefixTable(e, text).ids() == own.encode_ordinary(text)


def test_edits_change_only_what_they_reach(encoder, library):
    rng = random.Random(3)
    texts = list(random_texts(rng, [p.decode("utf-8", "ignore") for p in encoder.pieces], 300)) + ["".join(rng.choice("abcdeinst") for _ in range(1500)), "漢字かな" * 300]
    for text in texts:
        t = prefix_bpe.PrefixTable(encoder, text)
        for new in ("", "x", " and", "'s \n ", "漢"):
            a = rng.randrange(len(t.text) + 1)
            b = a if new == " and" else min(len(t.text), a + rng.randrange(5))
            t.replace(a, b, new)
            assert t.last.tolist() == prefix_bpe.PrefixTable(encoder, t.text).last.tolist()
            assert t.ids() == library.encode_ordinary(t.text)
        t.append(" more text")
        assert t.ids() == library.encode_ordinary(t.text)
    one_word = "".join(rng.choice("abcdeinst") for _ in range(20_000))
    t = prefix_bpe.PrefixTable(encoder, one_word)
    t.replace(5000, 5002, "xyz")
    assert t.filled < 300 and t.ids() == library.encode_ordinary(t.text)
    t.append("abc")
    assert t.filled < 300 and t.ids() == library.encode_ordinary(t.text)


def test_prefix_query_and_odd_rows(spark, library, odd):  # noqa: F811
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = {(r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r["text"] or "").encode())) for r in rows for ids in [library.encode_ordinary(r["text"] or "")]}
    assert {tuple(r) for r in queries.op13_prefix_bpe(spark, SF_SMALL).collect()} == want
    clash = odd.selectExpr("*", "'x' AS decoded", "1 AS token_ids", "'y' AS prefix_table")
    made = prefix_bpe.round_trip(clash, RANKS)
    for r in made.collect():
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == library.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert prefix_bpe.round_trip(odd.limit(0), RANKS).count() == 0
    back = prefix_bpe.decode(prefix_bpe.encode(odd, RANKS).selectExpr("*", "1 AS decoded"), RANKS).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)


def test_revise_on_spark(spark, library, odd):  # noqa: F811
    edits = odd.selectExpr("doc_id", "text", "kept", "CASE WHEN doc_id = 3 THEN 4 END AS a", "CASE WHEN doc_id = 3 THEN 6 END AS b", "CASE WHEN doc_id IS NOT NULL THEN ' tail' END AS new")
    made = prefix_bpe.revise(prefix_bpe.prefix_tables(edits, RANKS), RANKS, "a", "b", "new").collect()
    want = Counter((i, t[:4] + " tail" + t[6:] if i == 3 else t + (" tail" if i is not None else "")) for i, t in ((r["doc_id"], r["text"] or "") for r in odd.collect()))
    assert Counter((r["doc_id"], r["text"]) for r in made) == want and any(len(r["text"]) > len(LONG) for r in made)
    for r in made:
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == library.encode_ordinary(r["text"])

"""Operators of churnlake.llm against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from churnlake.llm import bpe, exact_dedup, html_extract, language_id, license_scan, mixing, pairwise_quality, quality_rules, queries, simhash, toxicity
from churnlake.llm.boosting import fit_boosted_trees, predict
from tests.conftest import SF_SMALL
from tests.helpers import same_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, _extra string"
LONG = "the quick brown fox " * 30_000
ROWS = [
    (1, None, "en", "a", 0, "x", None),
    (2, "", None, None, None, None, None),
    (3, "Same Text here", "en", "a", 1, "y", "z"),
    (3, "Same Text here", "en", "a", 1, "y", "z"),
    (4, "same text HERE", "en", "b", 1, None, "z"),
    (None, "orphan row without an id", "en", None, 1, None, None),
    (5, LONG, "en", "b", 1, None, None),
    (6, "  \n\t ", "de", "b", 1, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def lowered(text):
    return (text or "").encode().lower()


def test_oracles(spark, duck):
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, SF_SMALL)
        res = duck.execute(sql)
        ok, msg = same_rows(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in res.description], res.fetchall())
        assert ok, (name, msg)


def test_every_operator_takes_an_empty_table(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    frames = [
        license_scan.scan(none), quality_rules.quality(none), bpe.round_trip(none, queries.VOCABULARY), pairwise_quality.score_documents(none, labels), exact_dedup.exact_groups(none),
        exact_dedup.drop_exact_copies(none), toxicity.score_documents(none, labels), mixing.mix_plan(none), mixing.mix_documents(none), simhash.near_duplicates(none),
        language_id.identify(pages, none), html_extract.extract(pages, html_extract.fit(pages)),
    ]
    for f in frames:
        assert f.count() == 0


def test_exact_groups_against_brute_force(spark, docs, odd):
    for frame, cap in ((docs, 1 << 28), (docs, 1 << 10), (odd, 1 << 28)):
        rows = [(r["doc_id"], hashlib.sha256(lowered(r["text"])).hexdigest()) for r in frame.collect()]
        size = Counter(s for _, s in rows)
        best = {s: max((i for i, t in rows if t == s and i is not None), default=None) for s in size}
        got = [tuple(r) for r in exact_dedup.exact_groups(frame, max_filter_bits=cap).collect()]
        assert sorted(((i, best[s], size[s], s) for i, s in rows), key=str) == sorted(((i, k, n, s) for i, k, n, _, s in got), key=str)
        assert sorted(((s, k) for _, k, _, kept, s in got if kept), key=str) == sorted(best.items(), key=str)
        left = exact_dedup.drop_exact_copies(frame, max_filter_bits=cap)
        assert left.columns == frame.columns and sorted((r["doc_id"] for r in left.collect()), key=str) == sorted(best.values(), key=str)


def test_bloom_counters_miss_no_copy():
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    bits = 1 << 17
    counts = np.bincount(exact_dedup.positions(np.concatenate([h, h[:500]]), bits).ravel().astype(np.int64), minlength=bits)
    found = np.packbits(counts >= 2, bitorder="little")
    mark = exact_dedup.hit_twice(found, h)
    assert mark[:500].all() and mark[500:].mean() < 0.02


def brute_fingerprint(text):
    words = lowered(text).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(fps)
    for k, a in enumerate(fps):
        for b in fps[:k]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_near_duplicates_against_brute_force(odd, docs):
    for frame in (docs, odd):
        rows = [(r["doc_id"], brute_fingerprint(r["text"]) if len(r["text"] or "") < 50_000 else simhash.fingerprint(r["text"].encode())) for r in frame.collect()]
        root = brute_components({f for _, f in rows})
        least = {}
        for i, f in rows:
            if i is not None:
                least[root[f]] = min(i, least.get(root[f], i))
        expected = sorted(((i, f, least.get(root[f])) for i, f in rows), key=str)
        got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(frame).collect()), key=str)
        assert got == expected


def test_near_copies_are_dropped_by_row(spark, odd):
    rows = [
        (1, "near copies of one text"), (7, "near copies of one TEXT"), (7, "a text of its own, all alone"),  # 7 is not one document
        (2, "twice the same"), (2, "twice the same"), (2, "twice THE same"), (3, "twice the same"),
        (None, "without an id"), (None, "WITHOUT an id"), (None, "without an id"), (None, "another one without it"), (None, None), (9, ""),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for docs in (frame, odd, odd.limit(0)):
        got = simhash.drop_near_copies(docs)
        assert got.columns == docs.columns
        least = {}
        for r in docs.collect():
            f, i = brute_fingerprint(r["text"]) if len(r["text"] or "") < 50_000 else "long", r["doc_id"]
            least[f] = i if f not in least or least[f] is None else least[f] if i is None else min(i, least[f])
        # These texts are within three bits of each other only if their fingerprints are equal.
        assert sorted(((r["doc_id"], brute_fingerprint(r["text"]) if len(r["text"] or "") < 50_000 else "long") for r in got.collect()), key=str) == sorted(((i, f) for f, i in least.items()), key=str)


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(3)
    fps = set()
    for _ in range(12):  # chains of small steps, and points far from all others
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 5])):
                f ^= 1 << b
    root = brute_components(fps)
    frame = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    for cap in (8192, 1):
        found = {r["u"] % 2**64: r["v"] % 2**64 for r in simhash.components(simhash.links(frame, bucket_cap=cap)).collect()}
        classes = {}
        for f in fps:
            classes.setdefault(found.get(f, f), set()).add(f)
        brute = {}
        for f in fps:
            brute.setdefault(root[f], set()).add(f)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, brute.values()))


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    for _ in range(5000):
        e = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(e & m == 0 for m in simhash.MASKS.values())


def test_bpe_equals_the_library(spark, docs, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    rng = random.Random(1)
    letters = [chr(c) for c in [*range(0x250), *range(0x370, 0x400), 0x200B, 0x3000, 0x4E2D, 0x1F600, 0x200D, 0x2160]]
    parts = ["the", " ", "  ", "\n", "'s", "aaaa", "ab", "<|endoftext|>", "1234", "=====", "ing", "é"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(300)] + ["".join(rng.choice(parts) for _ in range(30)) for _ in range(300)] + ["a" * 3000, " " * 500]
    frame = spark.createDataFrame(enumerate(texts), "doc_id long, text string").unionByName(docs.select("doc_id", "text")).unionByName(odd.select("doc_id", "text"))
    for r in bpe.round_trip(frame, queries.VOCABULARY).collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == ids
        assert r["decoded"] == tokenizer.decode(ids, skip_special_tokens=False) == (r["text"] or "")
    two = bpe.decode(bpe.encode(odd, queries.VOCABULARY), queries.VOCABULARY)
    assert two.columns == [*odd.columns, "token_ids", "decoded"] and all((r["text"] or "") == r["decoded"] for r in two.collect())


def test_quality_counts_against_brute_force(docs, odd):
    for frame in (docs, odd):
        expected = []
        for r in frame.collect():
            w = WORD.findall(r["text"] or "")
            grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
            n = Counter(grams)
            covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
            lines = [x for x in (r["text"] or "").split("\n") if WORD.search(x)]
            failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
            expected.append((r["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r["text"] or "")), len(lines) - len(set(lines)), len(covered), failed))
        got = quality_rules.quality(frame)
        assert not got.where("kept and base_failed").count()
        cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(expected, key=str)


def test_quality_verdicts_agree_with_labels(spark, docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = quality_rules.quality(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in got}
    assert kept[1] > 0.95 and kept.get(0, 0) < 0.2


def test_scores_on_held_out_rows(spark):
    base = SF_SMALL.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    for module, label, least in ((toxicity, "toxic", 0.9), (pairwise_quality, "quality", 0.97)):
        got = module.score_documents(docs, labels)
        assert got.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0
        held = got.where("held_out").join(labels, "doc_id").select("score", label).toPandas()
        rank, pos = held["score"].rank(), held[label] == 1
        auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / pos.sum() / (~pos).sum()
        assert auc > least


def test_noisy_or_finds_the_offending_sentence(spark):
    model = toxicity.ToxicityModel({"vile": 9.0}, -4.0)
    rows = spark.createDataFrame([(1, "All fine. You are vile! Bye"), (2, None), (3, "Fine.")], "doc_id long, text string")
    got = toxicity.offending_sentences(rows, model).collect()
    assert [(r["doc_id"], r["sentence"], rows.first()["text"][r["begin"] : r["end"]].strip()) for r in got] == [(1, 1, "You are vile")]
    p = 1 / (1 + np.exp([4.0, -5.0, 4.0]))
    assert model.score("All fine. You are vile! Bye")[0] == pytest.approx(1 - np.prod(1 - p))
    assert [r["_tx"]["score"] for r in toxicity.score(rows, model).collect()][1] == 0.0


def test_toxicity_scores_do_not_shift_where_the_caps_bind(spark):
    # Half of the texts with "murky" are toxic; every tenth text is.
    rows = [(i, f"{'murky' if i % 100 < 9 or i % 10 == 9 and i % 100 < 90 else 'plain'} words here", int(i % 10 == 9)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scores = []
    for caps in ({}, {"max_clean": 1200}, {"max_clean": 1200, "max_toxic": 400}):
        scores.append(toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), **caps).score("murky words here")[0])
    assert max(scores) - min(scores) < 0.08 and max(scores) < 0.7


def test_scorers_take_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (5, 1, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    for module in (toxicity, pairwise_quality):
        assert module.score_documents(odd, labels).where("score between 0 and 1").count() == len(ROWS)


def test_mixing(spark, odd, docs):
    for frame in (odd, docs):
        got = mixing.mix_plan(frame).toPandas()
        again = mixing.mix_plan(frame.repartition(5)).toPandas()
        assert sorted(map(tuple, got.astype(str).values)) == sorted(map(tuple, again.astype(str).values))
        assert len(got) == frame.count() and (got["taken"] <= 2 * got["size"]).all()
        mixed = mixing.mix_documents(frame)
        assert mixed.columns == frame.columns
        assert sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) == got["taken"].sum()
    plan = spark.createDataFrame([("a", 20.0, 5.0), ("b", 200.0, 2.0), ("c", 40.0, 1.0)], "source string, cap double, weight double")
    assert mixing.water_level(plan, 195.0) == pytest.approx(135 / 2)  # a and c are clamped
    assert mixing.water_level(plan, 1000.0) is None


def test_license_scan(spark, odd):
    apache = license_scan.TEMPLATES["apache-2.0-header"]
    rows = [(1, "word " * 300 + apache + " more" * 40), (2, apache.replace("obtain", "get")), (3, " ".join(apache.split()[::2])), (4, "Released under the MIT License."), (5, None)]
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, "apache-2.0-header"] == 1.0 and 0.8 <= got[2, "apache-2.0-header"] < 1 and got[4, "mit"] == 1.0
    assert {k[0] for k in got} == {1, 2, 4}
    assert license_scan.scan(odd).count() == 0


def test_html_extraction(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    model = html_extract.fit(pages)
    odd = [(1, None, None), (2, "u", ""), (3, "u", "<p>a<b"), (4, "u", "<" * 2000), (5, "u", "<div>" * 500 + "deep" + "</div>" * 500), (6, None, "no markup at all")]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(odd, "page_id long, url string, html string"), model).collect()}
    assert got[1] == got[2] == "" and None not in got.values() and len(got) == len(odd)
    exact = total = 0
    for r in html_extract.extract(pages, model).join(pages, "page_id").collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)
        if article:
            blocks = [" ".join(__import__("html").unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article[1])]
            total, exact = total + 1, exact + (r["text"] == "\n".join(b for b in blocks if b))
    assert exact >= 0.98 * total > 0


def test_parser_and_decoding():
    page = html_extract.parse("<nav><a href=x>Home</a></nav><div class='ad'>Buy &amp; go</div><p>One <b>two<p>three<br>four<script>var t='</p>'</script><ul><li>x<li>y</ul>tail")
    assert [t for _, t, _ in page.blocks] == ["Home", "Buy & go", "One two", "three four", "x", "y", "tail"]
    p = np.full(len(page.tag), 0.5)
    for k, t in enumerate(page.tag):
        p[k] = 0.01 if t in ("nav", "div") else 0.99
    assert html_extract.decode(page, p) == ["One two", "three four", "x", "y", "tail"]


def test_parser_keeps_text_after_unclosed_elements_and_in_formulas():
    texts = lambda source: [t for _, t, _ in html_extract.parse(source).blocks]
    for name in ("svg", "object", "canvas", "audio", "video"):
        assert texts(f"<p>a</p><{name} class=x><p>b</p><p>c <{name}>gone</{name}> d</p>") == ["a", "b", "c d"]
        assert texts(f"<p>a <{name}>x<{name}>y</{name}>z</{name.upper()}> b</p><{name}/><p>c</p>") == ["a b", "c"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert texts("<p>a</p><script>var b = '<p>c</p>'") == ["a"]


def test_extraction_learns_from_pages_of_any_length_with_an_article(spark):
    said = "Some main text, of one sentence. "
    long = [(i if i else None, "u", f"<nav><a href=/>Home</a></nav><div><article><p>{said * 700}{i}</p></article></div><footer><p>Legal</p></footer>") for i in range(30)]
    without = [(100 + i, "u", f"<div><p>{said * 5}</p></div>") for i in range(30)]
    schema = "page_id long, url string, html string"
    frame = spark.createDataFrame([*long, *long, *without], schema)
    model = html_extract.fit(frame, max_pages=20)
    for r in html_extract.extract(frame.limit(30), model).collect():
        assert r["text"] == " ".join((said * 700).split()) + f" {r['page_id'] or 0}"
    only = html_extract.fit(spark.createDataFrame([*long, *long], schema), max_pages=20)
    assert all(np.array_equal(model[k], only[k]) for k in model)
    with pytest.raises(ValueError):
        html_extract.fit(spark.createDataFrame(without, schema))
    html_extract.fit(spark.createDataFrame([(1, "u", None), (2, "u", " ")], schema))


def test_boosted_trees_learn_an_interaction():
    x = np.random.default_rng(0).random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((predict(fit_boosted_trees(x, y), x) > 0.5) == y).mean() > 0.97


def test_language_id(spark, docs):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    extra = spark.createDataFrame([(-1, None, None), (-2, "http://h.example.de/", ""), (-3, "x", "<html lang=zz>")], "page_id long, url string, html string")
    got = language_id.identify(pages.select("page_id", "url", "html").unionAll(extra), docs).toPandas()
    known = got[got["declared"].isin(["en", "de", "fr", "es"])]
    assert len(got) == pages.count() + 3 and (known["declared"] == known["lang"]).mean() > 0.97
    assert got["lang"].notna().all() and got["probability"].between(0, 1).all()


def test_declared_language_is_found_anywhere(spark, docs):
    texts = {
        "de": ["<html lang=de>", "<!-- " + "licence " * 500 + "-->\n<!DOCTYPE html><HTML class='x' LANG='DE-at'>", "\n" * 50_000 + "<html\nlang = \"de\">", "<html class=a>" + "x" * 3000 + "<html lang=de>"],
        "none": ["", "<p>x</p>", "<html>" + "x" * 3000 + "<script>var s = '<html lang=\"fr\">'</script>", "<!-- <html lang=fr> --><html><p>lang=fr</p>", "<html" * 5000],
    }
    rows = [(k, "u", t, c) for k, (c, t) in enumerate((c, t) for c, ts in texts.items() for t in ts)]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["declared"] for r in language_id.identify(pages, docs).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_pipeline_against_brute_force(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    clean = {r["doc_id"] for r in toxicity.score_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), labels).where("score < 0.7").collect()}
    best = {}
    for i in sorted(clean):
        best[lowered(docs[i]["text"])] = i
    fps = {i: brute_fingerprint(docs[i]["text"]) for i in best.values()}
    root, least = brute_components(set(fps.values())), {}
    for i in sorted(fps):
        least.setdefault(root[fps[i]], i)
    stay = spark.createDataFrame([tuple(docs[i]) for i in least.values()], spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    size = {i: len(WORD.findall(docs[i]["text"] or "")) for i in least.values()}
    taken = {r["doc_id"]: r["taken"] // size[r["doc_id"]] for r in mixing.mix_plan(stay).collect() if size[r["doc_id"]]}
    got = Counter(r["doc_id"] for r in out.collect())
    assert {i: n for i, n in got.items() if size[i]} == {i: n for i, n in taken.items() if n}
    for r in out.collect():
        assert r["text"] == (docs[r["doc_id"]]["text"] or "") and r["n_tokens"] * 4 == len(r["token_ids"])

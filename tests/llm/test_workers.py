"""What Python workers do and keep in the pipeline."""

import re

import numpy as np

from churnlake.llm import bpe, exact_dedup
from churnlake.llm.queries import VOCABULARY


def test_a_task_of_exact_dedup_needs_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "Same"), (2, "same"), (3, "else"), (4, None), (None, ""), (4, None)], "doc_id long, text string")
    kept = exact_dedup.drop_exact_copies(docs)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"both\(", plan)) == len(re.findall("ArrowEvalPython", plan)) == 2  # once in either part of the union
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(2, "same"), (3, "else"), (4, None)]


def test_a_worker_keeps_a_small_encoder_and_not_the_vocabulary_beside_it():
    class Sent:
        value = vars(bpe.read_vocabulary(VOCABULARY))

    e = bpe._encoder(Sent)
    assert bpe._encoder(Sent) is e and [*Sent.value] == ["encoder"] and not hasattr(e, "v")
    held = [x for v in vars(e).values() for x in (v if isinstance(v, tuple) else [v]) if isinstance(x, np.ndarray)]
    assert sum(x.nbytes for x in held) < 32 * e.size


def test_borders_against_the_whole_spines():
    v = bpe.read_vocabulary(VOCABULARY)
    e = bpe.Encoder(v)
    made = {}
    for (a, b), (rank, new) in v.merges.items():
        if new not in made or rank < made[new][0]:
            made[new] = rank, a, b

    def spine(t, side):
        out, used = [], bpe.NEVER
        while True:
            out.append((t, used))
            if t not in made:
                return out
            used, t = made[t][0], made[t][side]

    rng = np.random.default_rng(7)
    pairs = np.array([*v.merges], dtype=np.int64)
    pairs = np.concatenate([rng.permutation(pairs)[:1500], np.stack([rng.permutation(pairs[:, 0])[:4000], rng.permutation(pairs[:, 1])[:4000]], axis=1)])
    want = [not any((m := v.merges.get((x, y))) and m[0] < p and m[0] <= q for x, p in spine(a, 2) for y, q in spine(b, 1)) for a, b in pairs.tolist()]
    assert e.compatible(pairs[:, 0], pairs[:, 1]).tolist() == want and 0.05 < np.mean(want) < 0.95

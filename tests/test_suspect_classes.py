"""Every pair of suspects follows from the rows of the classes."""

import random

from listforge.operators import removals as R


def test_pairs_of_suspects_follow_from_the_classes(spark):
    rng = random.Random(8)
    ids = [(f"L{k % 2}", k, rng.choice(["PASSPORT", "IMO", "OTHER"]), f"v{rng.randrange(15)}") for k in range(60) for _ in range(2)] + [("L0", 900, "IMO", "alone")]
    names = [(f"L{k % 2}", k, f"n{rng.randrange(12)}" if k % 7 else None) for k in range(60)]
    cands = [(f"L{k % 2}", k) for k in range(0, 60, 7)] + [("L0", 900)]
    rows = R.id_change_suspects(
        spark.createDataFrame(cands + cands[:2], "source_id string, source_key int"), spark.createDataFrame(ids, "source_id string, source_key int, id_type string, value_norm string"), spark.createDataFrame(names, "source_id string, source_key int, name_norm string")
    ).collect()
    held = {(s, k, "SHARED_IDENTIFIER", f"{t}:{v}") for s, k, t, v in ids if t != "OTHER"} | {(s, k, "SAME_NAME", n) for s, k, n in names if n}
    pairs = lambda marks, asked: {(a[:2], b[1], a[2]) for a in marks for b in marks if a[:2] in asked and (a[0], *a[2:]) == (b[0], *b[2:]) and a[1] != b[1]}
    assert pairs({tuple(r)[:4] for r in [(r.source_id, r.source_key, r.reason, r.value) for r in rows]}, {(r.source_id, r.source_key) for r in rows if r.candidate}) == pairs(held, set(cands)) != set()
    assert len(rows) == len({(r.source_id, r.source_key, r.reason, r.value) for r in rows})
    for r in rows:
        members = {k for s, k, why, v in held if (s, why, v) == (r.source_id, r.reason, r.value)}
        assert (r.first_key, r.n_others) == (min(members), len(members) - 1) and members == {x.source_key for x in rows if (x.source_id, x.reason, x.value) == (r.source_id, r.reason, r.value)}

"""Buckets of the rollups' state grow with it."""

import random
from collections import Counter

from listforge.llm import rollups


def test_buckets_follow_the_entries(spark):
    rng, now = random.Random(9), {}
    state = rollups.Rollup(spark, bucket_entries=10)
    seen = []
    for batch in range(6):
        rows = {}
        for _ in range((5, 60, 3, 200, 4, 1)[batch]):
            k = rng.randrange(400)
            rows[k] = (k, "t", rng.choice(["insert", "revise", "delete"]), rng.choice("xy"), None, rng.randrange(9))
        state.apply(f"{batch}", spark.createDataFrame(list(rows.values()), "doc_id long, tokenizer string, op string, source string, lang string, n_tokens long"))
        for k, _, op, source, _, n in rows.values():
            now.pop(k, None) if op == "delete" else now.update({k: (source, n)})
        assert {(r.doc_id, r.source, r.n_tokens) for r in state.entries().collect()} == {(k, *v) for k, v in now.items()}
        docs, tokens = Counter(s for s, _ in now.values()), Counter()
        for s, n in now.values():
            tokens[s] += n
        assert {(r.source, r.n_docs, r.n_tokens) for r in state.totals().collect()} == {(s, docs[s], tokens[s]) for s in docs}
        seen.append(state._places()[0])
    assert seen[0] == 1 and seen == sorted(seen) and seen[1] > 2 and seen[3] > seen[2]
    touched = [n for n in state._names(f"{state.path}/5/current") if n.startswith("bucket=")]
    assert len(touched) == 1  # a small batch writes the buckets of its keys only

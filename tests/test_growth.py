"""Steps whose rows must not grow with the product of two inputs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from listforge.operators import enrich as E
from listforge.operators import fuzzy as FZ
from listforge.operators import jsondiff as JD
from listforge.operators import monitor as MO
from listforge.operators import notices as G
from listforge.operators import removals as R
from listforge.plans import q_links as Q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def join_rows(df):
    """Rows that the joins of a collected frame gave."""

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().get("numOutputRows").get().value() if "Join" in name else 0
        return own + sum(walk(node.children().apply(k)) for k in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_words_around_a_reference_are_read_before_its_records_are_joined(spark):
    n = spark.createDataFrame([(k, "t", f"entry TAi.00{k % 2} was removed.", ["DELISTING"]) for k in range(6)], "notice_id int, title string, text string, action_types array<string>")
    keys = spark.createDataFrame([("UN_REF", "TAI001", "L", k) for k in range(30)], "key_type string, key_value string, source_id string, source_key int")
    df = G.id_links(n, G.references(n), keys)
    rows = df.collect()
    assert {(r.notice_id, r.source_key, r.link_type, r.verbatim_quote) for r in rows} == {(n, k, "DELISTING", "t entry TAi.001 was removed.") for n in (1, 3, 5) for k in range(30)} and len(rows) == 90
    text = plan(df).split("Initial Plan")[-1]
    assert 0 < text.index("Join") < text.index("instr(")


def test_signals_do_not_meet_every_publish_of_their_target(spark):
    at = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * k)
    sig = [(k, f"S{k % 2}", at(k)) for k in range(400)] + [(900, None, at(3)), (901, "S0", None), (902, "none", at(5)), (903, "S1", at(4000))]
    pub = [(f"S{k % 2}", at(k + k % 3)) for k in range(0, 800, 2)] + [("S1", at(k)) for k in range(5, 390, 40)] + [(None, at(9)), ("S0", None)]
    s = spark.createDataFrame(sig, "signal_id int, target_source_id string, observed_at timestamp")
    p = spark.createDataFrame(pub, "source_id string, published_at timestamp")
    first = lambda t, o: min((x for n, x in pub if t and o and x and n == t and x >= o), default=None)
    df = G.consumed(s, p)
    got = {r.signal_id: r.consumed_at for r in df.collect()}
    assert got == {k: first(t, o) for k, t, o in sig} and df.columns == [*s.columns, "consumed_at"]
    assert join_rows(df) <= len(sig)
    late = MO.unanswered(s, p, F.lit(dt.datetime(2024, 1, 2)))
    want = {k for k, t, o in sig if o and o + dt.timedelta(hours=6) <= dt.datetime(2024, 1, 2) and not (first(t, o) and first(t, o) <= o + dt.timedelta(hours=6))}
    assert {r.signal_id for r in late.collect()} == want and join_rows(late) <= len(sig)


def test_only_the_first_aircraft_of_a_number_meets_the_subjects(spark):
    subj = spark.createDataFrame([(k, "N-7" if k % 50 == 0 else "D-1", "s 1", ["model a", "other", None][k % 3]) for k in range(300)], "subject_id int, tail string, serial string, model string")
    master = spark.createDataFrame([(f"N{k}", "s1", "c1" if k < 290 else "c2", 1000 - k) for k in range(300)] + [("7", "x", None, 5)], "n_number string, serial string, code string, pos int")
    df = E.aircraft(subj, master, spark.createDataFrame([("c1", "Model A"), ("c2", "Model")], "code string, model string"))
    got = {r.subject_id: (r.provider_key, r.match_method, r.score) for r in df.collect()}
    assert got == {k: ("N7", "TAIL_NUMBER", 1.0) if k % 50 == 0 else ("N299", "SERIAL_NUMBER", 1.0 if k % 3 == 0 else 0.9) for k in range(300)}
    assert join_rows(df) < 1000  # 90,000 pairs share the serial number


def test_links_of_extractions_are_not_shuffled(spark):
    text = plan(Q.g09(spark, "/root/testdata/sf0.001"))
    assert "Aggregate" in text and text.index("Join") < text.index("Aggregate")


def test_levels_of_documents_are_spread_over_tasks(spark):
    docs = spark.range(0, 64, 1, 1).selectExpr("id", "'{\"a\": {\"b\": 1}}' AS doc")
    assert JD.nodes(docs, ["id"], "doc").select(F.input_file_name().alias("f")).distinct().count() > 6  # three levels


def test_few_different_names_share_a_key(spark):
    rng = random.Random(3)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    names = {" ".join(sorted("".join(rng.choice(syllables) for _ in range(rng.choice([2, 2, 3]))) for _ in range(rng.choice([2, 3])))) for _ in range(1500)}
    df = spark.createDataFrame([(n, len(n)) for n in sorted(names)], "name string, len int")
    parts = spark.createDataFrame(FZ._parts(0.85, FZ.LONG), "of int, i int, at int, size int, own int, before int, last int")
    shorter = FZ._shorter_keys(df, parts, FZ._slack(0.85)).withColumnRenamed("name", "other")
    met = FZ._longer_keys(df, parts, FZ._slack(0.85)).join(shorter, "key").select("name", "other").distinct().count()
    assert len(names) <= met < len(names) ** 2 / 50


def test_records_of_many_keys_meet_no_records(spark, monkeypatch):
    monkeypatch.setattr(R, "durable", lambda df, tag="": df)
    held = {k: {f"p{(k * 7 + j * j) % 23}" for j in range(10 if k % 160 == 0 else 2)} for k in range(12000)}
    keys = spark.createDataFrame([("S", k, "PASSPORT", v) for k, vs in held.items() for v in vs], "source_id string, source_key int, key_type string, key_value string")
    ask = [k for k in held if k % 160 == 0 or k % 64 == 1]
    df = R.crosslist_hits(spark.createDataFrame([("S", k) for k in ask], "source_id string, source_key int"), keys, ["source_id", "source_key"])
    want = {k: sum(bool(held[k] & o) for o in held.values()) - 1 for k in ask}
    assert {r.source_key: r.n_hits for r in df.collect()} == {k: n for k, n in want.items() if n}
    assert join_rows(df) < sum(n for k, n in want.items() if len(held[k]) > 8) / 2

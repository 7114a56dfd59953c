"""Rows that the last pass over the texts gives to its shuffle."""

from listforge.llm import collocations as C


def made(node):
    """Rows that the Python step of a collected frame gave."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return made(node.executedPlan())
    if "QueryStage" in name:
        return made(node.plan())
    own = node.metrics().get("pythonNumRowsReceived").get().value() if name == "MapInArrow" else 0
    return own + sum(made(node.children().apply(k)) for k in range(node.children().size()))


def test_a_phrase_gives_a_row_a_task_and_tasks_are_few(spark, monkeypatch):
    monkeypatch.setattr(C, "durable", lambda df, tag="": df)
    docs = spark.range(0, 640, 1, 160).selectExpr("id AS doc_id", "'one two three four' AS text", "'en' AS lang")
    df = C.frequent_phrases(docs, bits=1 << 12)
    got = {(r.n, r.phrase): r.c for r in df.collect()}
    assert len(got) == 11 and got[0, ""] == 2560 and set(got.values()) == {640, 2560}
    assert made(df._jdf.queryExecution().executedPlan()) <= 11 * C.WAVES * spark.sparkContext.defaultParallelism  # 160 tasks read the documents

"""Subjects without a match report their best score."""

from listforge.functions import names as N
from listforge.operators import enrich as E


def test_a_company_without_a_match_reports_its_nearest_score(spark):
    reg = [("0000001", "alpha trading house"), ("0000002", "beta shipping line"), ("0000003", "gamma shipping")]
    subj = [(1, "GB", "x", "alpha trading works"), (2, None, "x", "beta shipping line"), (3, "GB", "x", "nothing like it"), (4, "GB", "x", None)]
    got = {r.subject_id: (r.score, r.near_score, r.status, r.provider_key) for r in E.companies(spark.createDataFrame(subj, "subject_id int, country string, reg_norm string, core string"), spark.createDataFrame(reg, "number string, core string")).collect()}
    a, b = (" ".join(sorted(x.split())) for x in ("alpha trading works", "alpha trading house"))
    assert got[1] == (0.0, round(2 * N._lcs(a, b) / (len(a) + len(b)), 4), "NO_MATCH", None)
    assert got[2] == (1.0, 1.0, "AUTO_ACCEPTED", "0000002") and got[3] == got[4] == (0.0, 0.0, "NO_MATCH", None)

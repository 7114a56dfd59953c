"""Normalisers, case by case, and properties that must hold for any input."""

import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listforge.functions import countries as K
from listforge.functions import dates as D
from listforge.functions import names as N
from listforge.functions import text as T
from listforge.operators import quality as Q
from listforge.operators import versioning as V
from listforge.plans import marts as M


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select(f(F.col("v")).alias("o"), "i").orderBy("i").collect()]


def test_dates(spark):
    cases = {
        "1970-02-03": ("1970-02-03", 1970, None, None, "DAY"), "1970-02-31": (None, 1970, None, None, "UNKNOWN"), "1970-00-00": (None, 1970, None, None, "YEAR"), "1970-05-00": ("1970-05-01", 1970, None, None, "MONTH"),
        "1970-05": ("1970-05-01", 1970, None, None, "MONTH"), "dd/mm/1965": (None, 1965, None, None, "YEAR"), "00/04/1965": ("1965-04-01", 1965, None, None, "MONTH"), "03/04/1965": ("1965-04-03", 1965, None, None, "DAY"),
        "31/02/1965": (None, 1965, None, None, "UNKNOWN"), "01 Jan 1970": ("1970-01-01", 1970, None, None, "DAY"), "31 Feb 1970": (None, 1970, None, None, "YEAR"), "Sept. 1970": ("1970-09-01", 1970, None, None, "MONTH"),
        "circa 1970": (None, 1970, None, None, "YEAR"), "1970": (None, 1970, None, None, "YEAR"), "Between 1965 and 1969": (None, None, 1965, 1969, "RANGE"), "1969-1965": (None, None, None, None, "UNKNOWN"),
        "1965 to 1969": (None, None, 1965, 1969, "RANGE"), "soon": (None, None, None, None, "UNKNOWN"),
    }
    for raw, got in zip(cases, column(spark, cases, D.parse_partial), strict=True):
        assert (got.date_value and str(got.date_value), got.year, got.year_from, got.year_to, got.precision) == cases[raw], raw
        assert got.raw == raw
    assert column(spark, ["", "  ", None], D.parse_partial) == [None] * 3
    full = {"2020-01-02T03:04:05": "2020-01-02", "05-Mar-2020": "2020-03-05", "3/4/2020": "2020-04-03", "12/25/2020": "2020-12-25", "2020": None}
    assert [x and str(x) for x in column(spark, full, D.parse_full)] == list(full.values())


def test_countries(spark):
    dim = K.dimension(spark)
    cases = {"IR": "IR", "irn": "IR", "Iran (Islamic Republic of)": "IR", "Tehran, Iran": "IR", "The Bahamas": "BS", " GERMANY. ": "DE", "Atlantis": None, "": None, "Russian Federation": "RU", "Korea, Democratic People's Republic of": "KP", "zz": None, "u.s.a.": "US"}
    rows = K.to_iso2(spark.createDataFrame([(k,) for k in cases], "raw string"), "raw", "iso", dim).collect()
    assert {r.raw: r.iso for r in rows} == cases


def test_identifiers(spark):
    assert column(spark, ["9074729", "9074728", "12", None], lambda c: T.imo_checksum_ok(c)) == [True, False, False, False]
    assert column(spark, ["IMO 9074729", "x 9074729.", "12345678", "IMO90 74729"], T.extract_imo) == ["9074729", "9074729", None, "9074729"]
    assert column(spark, ["5493001KJTIIGC8Y1R12", "5493001KJTIIGC8Y1R13", "short"], T.lei_checksum_ok) == [True, False, False]
    labels = {"IMO number": "IMO", "Minimum": "OTHER", "Tax ID No.": "TAX", "D-U-N-S Number": "OTHER", "Passport": "PASSPORT", "National ID No.": "NATIONAL_ID", "Aircraft Manufacturer's Serial Number (MSN)": "AIRCRAFT_MSN", "Registration Number": "REGISTRATION", "SWIFT/BIC": "SWIFT", "Email Address": "EMAIL", "": "OTHER"}
    assert column(spark, labels, T.classify_label) == list(labels.values())


def test_names(spark):
    cases = {"Étienne  O'Brien-Smith": "etienne o brien smith", "STRASSE Groß": "strasse gross", " A.B. ": "a b", "Müller (Jr.)": "muller jr"}
    assert column(spark, cases, N.normalize_name) == list(cases.values())
    df = spark.createDataFrame([("gulf petro trading", "gulf petroleum trading"), ("a b", "b a"), ("", "x"), ("same", "same")], "a string, b string")
    assert [r[0] for r in df.select(N.name_score(F.col("a"), F.col("b"))).collect()] == [0.9, 1.0, 0.0, 1.0]
    assert column(spark, ["gulf trading co ltd", "the holding"], T.core_name) == ["gulf trading", ""]


def test_html_and_links(spark):
    page = "<html><head><style>p{}</style><script>x('<p>')</script></head><body><nav>menu</nav><p>One &amp; two</p><div>three<br>four</div></body></html>"
    assert column(spark, [page], T.html_to_text) == ["One & two\nthree\nfour"]
    assert column(spark, ["https://x/?uri=CELEX:52020R1&q", "https://x"], lambda c: T.act_from_notice(c, F.lit("e"))) == ["52020R1", "e"]
    text = "The delisting of X. " + "y " * 400 + "TAi.080 was designated " + "z " * 400
    assert column(spark, [text], lambda c: T.link_type_near(c, F.lit("TAi.080"), F.array().cast("array<string>"))) == ["LISTING"]
    assert column(spark, [text], lambda c: T.link_type_near(c, F.lit("The del"), F.array().cast("array<string>"))) == ["DELISTING"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text(string.ascii_lowercase, max_size=12), st.text(string.ascii_lowercase, max_size=12)), min_size=1, max_size=20))
def test_common_subsequence(pairs):
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            prev = 0
            for j, y in enumerate(b):
                prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    assert all(N._lcs(a, b) == plain(a, b) for a, b in pairs)


@settings(max_examples=5, deadline=None)
@given(versions=st.lists(st.dictionaries(st.integers(0, 12), st.sampled_from("abc"), max_size=10), min_size=1, max_size=5))
def test_replay_gives_every_version_again(spark, versions):
    keys, schema = ["source_id", "source_key"], "source_id string, source_key int, content_hash string"
    frames = [spark.createDataFrame([("S", k, v) for k, v in d.items()], schema) for d in versions]
    old, history, log = spark.createDataFrame([], schema), spark.createDataFrame([], schema), None
    for seq, new in enumerate(frames, 1):
        changes = V.promote_relisted(V.diff(old, new, keys), history, keys)
        rows = V.log_rows(changes, seq)
        log = rows if log is None else log.unionByName(rows)
        p = V.preview(changes).first()
        assert p.previous + p.added - p.removed == new.count()
        old, history = new, history.unionByName(new)
    valid = V.validity(log, keys).cache()
    for seq, d in enumerate(versions, 1):
        at = V.as_of(valid, spark.createDataFrame([("S", seq)], "source_id string, pin int")).collect()
        assert {r.source_key: r.new_hash for r in at} == d


def test_same_version_has_no_diff(spark):
    df = spark.createDataFrame([("S", k, str(k)) for k in range(5)], "source_id string, source_key int, content_hash string")
    assert V.log_rows(V.diff(df, df, ["source_id", "source_key"]), 1).count() == 0


@pytest.mark.parametrize("removed,added,previous,gates", [(51, 0, 10_000, {"LARGE_REMOVAL"}), (6, 0, 100, {"LARGE_REMOVAL"}), (5, 0, 100, set()), (0, 1501, 10_000, set()), (0, 4000, 10_000, {"LARGE_ADDITION"}), (60, 4000, 0, set())])
def test_large_changes(spark, removed, added, previous, gates):
    m = spark.createDataFrame([(1, 1000, 0, 0, 0, 0, 0, added, removed, previous)], "version_id int, records long, skipped long, duplicates long, drift long, bad_countries long, bad_dates long, added long, removed long, previous long")
    spoken = Q.gates(m, min_records=5)
    assert {r.gate for r in spoken.collect()} == gates
    assert Q.outcome(m, spoken, "version_id").first().outcome == ("HOLD" if gates else "PASS")


def test_marts_hold_no_record_columns(spark):
    """The columns of marts that report on records must not name or identify one."""
    from listforge.plans import q_marts  # noqa: F401
    from listforge.plans.registry import QUERIES

    banned = {"primary_name", "full_name", "source_key", "value_norm", "identifiers", "names", "addresses", "birth_dates"}
    for name, f in QUERIES.items():
        if name.startswith("k"):
            assert not banned & set(f(spark, "/root/testdata/sf0.001").columns), name
    M.register({"state": QUERIES["k30_state_summary"](spark, "/root/testdata/sf0.001")})
    assert spark.sql("SELECT count(*) FROM v_state").first()[0] > 0


def test_white_space_of_any_script(spark):
    nb = " "
    got = column(spark, ["\t1970-01-02", "1970-01-02\n", f"{nb}1970-01-02{nb}", f"2{nb}Jan{nb} 1970", "\t", nb, "\x1f1970"], D.parse_partial)
    assert [g and g.precision for g in got] == ["DAY", "DAY", "DAY", "DAY", None, None, "YEAR"] and got[2].raw == "1970-01-02"
    assert [x and str(x) for x in column(spark, ["\t2020-01-02T03:04:05 ", f"05-Mar-2020{nb}"], D.parse_full)] == ["2020-01-02", "2020-03-05"]
    assert column(spark, [f"a{nb}{nb}b  c\t", nb, None], T.squeeze) == ["a b c", "", None]
    assert column(spark, [f"a{nb}-1\t"], T.compact) == ["A1"]
    ids = column(spark, ["\t", nb, f" X1{nb}"], lambda c: T.make_identifier(F.lit("Passport"), c))
    assert ids[:2] == [None, None] and (ids[2].value, ids[2].value_norm) == ("X1", "X1")
    dim = K.dimension(spark)
    rows = K.to_iso2(spark.createDataFrame([("\tIran\n",), (f"{nb}de",), (f"The{nb}Bahamas",)], "raw string"), "raw", "iso", dim).collect()
    assert sorted(r.iso for r in rows) == ["BS", "DE", "IR"]


def test_names_of_any_script(spark):
    """Every name folds as its characters do: decomposed, without marks, case-folded, punctuation as blanks."""
    import unicodedata as ud

    names = ["Ξενοφών", "İstanbul Ltd", "ﬁrst^class`s", "a^b`c", "Nguyễn—Văn", "ŉame", "محمد عَلي", "x_y", "", " \t", "ＦＵＬＬ", "가나", "A B", None]

    def plain(s):
        kept = "".join(c for c in ud.normalize("NFKD", s) if ud.category(c) not in ("Mn", "Lm", "Sk")).casefold()
        return " ".join("".join(c if c.isalnum() or c == "_" else " " for c in kept).split())

    assert column(spark, names, N.normalize_name) == [n if n is None else plain(n) for n in names]


def test_odd_dates(spark):
    cases = {"1970 - 05": "UNKNOWN", "5.6.1970": "DAY", "1970-05-06Tx": "DAY", "1970-05-06 x": "UNKNOWN", "c1970": "YEAR", "c. 1970": "YEAR", "about1970": "UNKNOWN", "about 1970": "YEAR", "1965–1969": "RANGE", "from 1965 and 1969 on": "RANGE",
             "12 Foo 1970": "UNKNOWN", "1 may 1970": "DAY", "00/mm/1970": "YEAR", "dd/04/1970": "MONTH", "mm/dd/1970": "UNKNOWN", "123/04/1970": "UNKNOWN"}
    assert {k: v.precision for k, v in zip(cases, column(spark, cases, D.parse_partial), strict=True)} == cases

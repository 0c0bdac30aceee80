"""Names, forms and queries of the roster."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionflow.operators import names, queries


def forms(spark, raw, affiliation=""):
    df = spark.createDataFrame([(f"K{i}", 1, n, affiliation) for i, n in enumerate(raw)], "kol_id string, roster_seq int, kol_name string, affiliation string")
    return names.name_forms(df)


def test_clean_names(spark):
    cases = {
        "Dr. John A. Smith, MD, PhD": "John A. Smith", "Jane Doe MD FACC": "Jane Doe", "Robert Paul Jones MSN APRN": "Robert Paul Jones", "Bertrand Marquess Anz, III": "Bertrand Marquess Anz", "Dennis F Moore, Jr": "Dennis F Moore",
        "Hai C Do": "Hai C Do", "Cynthia Xiuguang Ma": "Cynthia Xiuguang Ma", "Yuen Tat So": "Yuen Tat So", "John Alan Smith DO": "John Alan Smith", "Jane Ann Doe PhD": "Jane Ann Doe", "Smith, John": "Smith, John", "John MD": "John MD", None: "", "()": "",
    }
    got = {r.kol_name: r.clean_name for r in forms(spark, list(cases)).collect()}
    assert got == cases


def test_parentheticals_and_forms(spark):
    cases = {
        "Benjamin (Ben) Joseph Osborne": ("Benjamin Osborne", "Benjamin J Osborne", ["Ben Osborne"]),
        "Ericka Portley Greene (Simpson)": ("Ericka Greene", "Ericka P Greene", ["Ericka Simpson"]),
        "Amanda Lee (Rowlands) Piquet": ("Amanda Piquet", "Amanda L Piquet", ["Amanda Rowlands"]),
        "Ghulam Rehman (Manni) Mohy-Ud-Din (Mohyuddin)": ("Ghulam Mohy-Ud-Din", "Ghulam R Mohy-Ud-Din", ["Ghulam Manni", "Ghulam Mohyuddin"]),
        "Carlyn Rose Co Tan (Chun-Pin Chen)": ("Carlyn Tan", "Carlyn R C Tan", ["Chun-Pin Chen"]),
        'Jijun "Jane" Liu': ("Jijun Liu", "Jijun Liu", ["Jane Liu"]),
        "Ghazala S (R) Hayat": ("Ghazala Hayat", "Ghazala S Hayat", []),
        'Bethanie "Beth" Shannon Van Horne': ("Bethanie Van Horne", "Bethanie S Van Horne", ["Beth Van Horne"]),
        "Van Minh Nguyen": ("Van Nguyen", "Van M Nguyen", []),
        "Cher": ("Cher Cher", "Cher Cher", []),
    }
    got = {r.kol_name: (r.forms.short, r.forms.initial, list(r.forms.extras)) for r in forms(spark, list(cases)).collect()}
    assert got == cases


def test_wrong_column(spark):
    cases = {"MD, MBA, MS, FACS, FRCS": True, "MD,PhD": False, "UCB": True, "Mayo Clinic": False, "": False, None: False}
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert [r[0] for r in df.select(names.looks_like_suffix(F.col("v"))).collect()] == list(cases.values())


def test_clean_roster(spark):
    rows = [("1", " Ann Lee ", None, "MD, MBA", "x"), ("", "No Id", "", "", ""), ("2", None, "", "", ""), ("3", "Bo Ray", "DO", "MD", ""), ("1", "Ann Lee", "", "", "")]
    got = sorted(map(tuple, names.clean_roster(spark.createDataFrame(rows, "kol_id string, kol_name string, suffix string, affiliation string, specialty string")).collect()))
    assert got == [("1", 1, "Ann Lee", "", "", "", False), ("1", 2, "Ann Lee", "MD, MBA", "", "x", True), ("3", 1, "Bo Ray", "DO", "", "", True)]


def test_manifest(spark):
    plain = queries.manifest(forms(spark, ["John A. Smith", "()"])).collect()
    assert len(plain) == 6 and plain[0].query == '("John A. Smith" OR "John Smith" OR "John A Smith") (MD OR Dr OR PhD)'
    anchored = queries.manifest(forms(spark, ["Michael Scott Perry"], 'Cook "Children\'s"  (Medical) Center of Fort Worth Texas')).collect()
    assert all(r.query.endswith(" \"Cook Children's Medical Center of Fort\"") for r in anchored)
    assert anchored[0].query.startswith('("Michael Scott Perry" OR "Michael Perry") ')
    some = queries.manifest(forms(spark, ["John Smith"]), [1, 3])
    assert [r.cluster_no for r in some.orderBy("cluster_no").collect()] == [1, 3] and some.first().query.startswith('"John Smith" (MD')


def test_batches_and_buckets(spark):
    rows = [("K", 1, i, f" q{i} ") for i in range(1, 8)] + [("K", 1, 8, " ")]
    df = spark.createDataFrame(rows, "kol_id string, roster_seq int, cluster_no int, query string")
    sizes = [[q.query for q in r.queries] for r in queries.batches(df, 6).orderBy("chunk_no").collect()]
    assert sizes == [["q1", "q2", "q3", "q4", "q5", "q6"], ["q7"]]
    assert [queries.recency_bucket(n) for n in (0, 1, 7, 9, 31)] == ["qdr:d", "qdr:d", "qdr:w", "qdr:m", "qdr:y"]


part = st.sampled_from(["Ann", "Bo", "van", "O'Hara", "(Nick)", '"Jo"', "(Mary Lou)", "Li-Wei", "MD,", "PhD", "Dr.", "de", "José", "(", '"'])


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(part, min_size=1, max_size=5).map(" ".join), min_size=20, max_size=40), st.sampled_from(["", "A Very Long Name Of Some Institute"]))
def test_queries_stay_in_budget(spark, raw, affiliation):
    for r in queries.manifest(forms(spark, raw, affiliation)).collect():
        assert len(r.query.split()) <= 32
        for phrase in r.query.split('"')[1::2]:
            assert "(" not in phrase and ")" not in phrase

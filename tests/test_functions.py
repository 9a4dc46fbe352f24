"""Column functions on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from lodestone.functions import normalizers as N
from lodestone.functions import text as X
from lodestone.functions.dictionaries import MATCH_ORDER, SKILL_ALIASES, skill_name
from lodestone.operators import confidence, extract_text, identity, validation
from lodestone.sources.recruiter_csv import REQUIRED


def values(spark, rows, column):
    made = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, x string")
    return [r[1] for r in made.select("k", column(F.col("x")).alias("y")).orderBy("k").collect()]


CASES = [
    (N.person_name, {"  jane   SMITH jr.": "Jane Smith JR", "JK rowling iii": "JK Rowling III", "": None, None: None, "o'neil": "O'neil", "ABCD": "Abcd"}),
    (N.phone, {"+1 (415) 555-0101": "+14155550101", "0044 20 1234": "+44201234", "555-0199": "5550199", "12345678901": "+12345678901", "123": None, None: None, "1" * 16: None}),
    (lambda c: N.date(c).cast("string"), {"2015": "2015-01-01", "2020-03-04": "2020-03-04", "March 4, 2020": "2020-03-04", "4 Mar 2020": "2020-03-04", "March 4th, 2020": "2020-03-04", "1st sept. 2019": "2019-09-01", "Dec. 22nd 2020": "2020-12-22", "the 1st": None, "Jan 2020": None, "soon": None, "2020-13-45": None, None: None}),
    (lambda c: N.date(c, strict=False).cast("string"), {"Jan 2020": "2020-01-01", "january 2020": "2020-01-01"}),
    (X.canonical_url, {"https://LinkedIn.com": "https://linkedin.com/", "HTTP://A.b/C?d": "http://a.b/C?d", "ftp://x": None, None: None}),
    (skill_name, {" PYTHON ": "Python", "nodejs": "Node.js", "Excel": "Excel"}),
    (extract_text.clean_entity, {"2019 Acme Labs, skills Java": "Acme Labs", "experience": None, None: None}),
]


@pytest.mark.parametrize(("column", "cases"), CASES)
def test_scalars(spark, column, cases):
    assert values(spark, list(cases), column) == list(cases.values())


def test_location(spark):
    found = values(spark, ["Pune", "Mumbai, India", "Austin, Texas", "Austin, Texas, usa", "python", None, " , "], N.location)
    assert [tuple(f)[:3] for f in found] == [("Pune", None, None), ("Mumbai", None, "India"), ("Austin", "Texas", None), ("Austin", "Texas", "United States"), (None, None, None), (None, None, None), (None, None, None)]


def test_date_range(spark):
    day = datetime.date
    found = values(spark, ["2015 - 2017", "2015 to Present", "2015–now", "2016", "", None], N.date_range)
    assert [tuple(f) for f in found] == [(day(2015, 1, 1), day(2017, 1, 1), False), (day(2015, 1, 1), None, True), (day(2015, 1, 1), None, True), (day(2016, 1, 1), None, False), (None, None, False), (None, None, False)]


def test_distinct_keeps_order_and_is_idempotent(spark):
    split = lambda c: F.split(c, ",")
    found = values(spark, ["b,A,a,,B,c", "", None], lambda c: X.distinct(split(c)))
    assert found == [["b", "A", "c"], [], None]
    assert values(spark, ["b,A,a,,B,c"], lambda c: X.distinct(X.distinct(split(c))))[0] == found[0]


def test_text_fields(spark):
    text = "Ann Lee\nRome, Italy | ann@x.org\nSummary\nWorks with node.js and C++; not Javascripting.\nExperience\n- bullet engineer\nworked at Blue Systems from 2019\nEducation\nBachelor of Arts, Open College 2012\nCall +39 06 1234 5678 or www.ann.example"
    one = lambda f: values(spark, [text], f)[0]
    assert one(lambda c: extract_text.person(X.lines(c))) == "Ann Lee"
    assert one(extract_text.skills) == ["Node.js", "C++"]
    assert one(extract_text.emails) == ["ann@x.org"] and one(extract_text.phones) == ["+39 06 1234 5678"] and one(extract_text.urls) == ["https://www.ann.example"]
    sections = one(lambda c: extract_text.sections(X.lines(c)))
    assert list(sections) == ["summary", "experience", "education"] and sections["experience"] == ["- bullet engineer", "worked at Blue Systems from 2019"]
    job = one(lambda c: extract_text.experience(extract_text.section_or_all(X.lines(c), extract_text.sections(X.lines(c)), "experience"), F.array().cast("array<string>")))
    assert [(j["organization"], j["date_range_text"]) for j in job] == [("Blue Systems", "2019")]
    assert "Rome, Italy" in one(lambda c: extract_text.places(X.lines(c), X.sentences(c), extract_text.place_mentions(X.sentences(c))))


def test_aliases_are_matched_longest_first():
    assert len(SKILL_ALIASES) == 50 and MATCH_ORDER[0] == "machine learning" and MATCH_ORDER[-1] == "r"


def test_validation(spark):
    row = {"record_id": "1", "source_type": "recruiter_csv", "file_name": "a.csv", "fieldnames": REQUIRED, "payload": dict.fromkeys(REQUIRED, "x") | {"email": "a@b.org", "phone": "1234567"}, "raw_text": "t"}
    odd = [
        row,
        row | {"payload": row["payload"] | {"email": "bad", "phone": "12-34", "name": " "}},
        row | {"file_name": "a.txt", "fieldnames": ["name"]},
        row | {"source_type": "resume_txt", "file_name": "a.txt"},
        row | {"source_type": "other"},
        row | {"payload": {}, "raw_text": " "},
        row | {"payload": row["payload"] | {"email": None, "phone": None}, "raw_text": None},
    ]
    made = spark.createDataFrame(odd, "record_id string, source_type string, file_name string, fieldnames array<string>, payload map<string,string>, raw_text string")
    codes = [[i["code"] for i in r["issues"]] for r in validation.with_issues(made).collect()]
    assert codes[0] == [] and codes[1] == ["missing_required_value", "malformed_email", "malformed_phone_number"]
    assert codes[2] == ["unsupported_csv_file_type", "missing_required_columns"] and codes[3] == ["unsupported_resume_file_type"] and codes[4] == ["unsupported_source_type"]
    assert "empty_record" in codes[5] and codes[6] == ["missing_required_value"]
    assert validation.drop_fatal(made).count() == 3
    report = validation.report(made).first()
    assert (report["total_records"], report["valid_records"], report["has_fatals"]) == (7, 3, True)


def test_cascade_against_brute_force(spark):
    import random

    draw = random.Random(3)
    rows = [(f"n{k}", k, draw.choice([None, "ann lee", "bob ray", "cy"]), (draw.choice([None, "a@x", "b@x", "c@x", f"{k}@x"]), draw.choice([None, "111", "222", str(k)])), (None, None, None, None, draw.choice([None, "rome", "oslo"]))) for k in range(200)]
    made = spark.createDataFrame(rows, "normalized_id string, seq long, full_name string, contact struct<email: string, phone: string>, location struct<city: string, state_or_region: string, country: string, postal_code: string, raw_location: string>")
    found = {r["normalized_id"]: r["rule"] for r in identity.assign(made).collect()}
    expected = {}
    key = {"email_match": lambda r: r[3][0], "phone_match": lambda r: r[3][1], "name_location_match": lambda r: (r[2], r[4][4]) if r[2] and r[4][4] else None, "ambiguous": lambda r: r[2]}
    for rule, of in key.items():
        free = [r for r in rows if r[0] not in expected and of(r) is not None]
        counts = {}
        for r in free:
            counts[of(r)] = counts.get(of(r), 0) + 1
        expected |= {r[0]: rule for r in free if counts[of(r)] >= 2}
    assert found == {r[0]: expected.get(r[0], "no_match") for r in rows} and len(set(found.values())) == 5


def test_score_branches(spark):
    schema = "canonical_profile struct<full_name: string, contact: struct<email: string, phone: string, alternate_emails: array<string>, alternate_phones: array<string>>, headline: string, location: struct<raw_location: string>, skills: array<struct<name: string>>, work_experience: array<string>, education: array<string>>, provenance array<struct<field_name: string, source_name: string, method: string>>, merged_record_ids array<string>, match_evidence array<struct<rule_name: string>>, attributes struct<resolution_status: string>"

    def row(skills, methods, ids, rule, status, others, names=("a",)):
        return ((None, (None, None, others, []), None, (None,), [(s,) for s in skills], [], []), [("skills" if k < len(skills) else "x", names[k % len(names)], m) for k, m in enumerate(methods)], ids, [(rule,)], (status,))

    rows = [row("ab", ["direct_extraction"] * 2, ["1"], "email_match", "matched", []), row("abc", ["merged", "merged", "conflict_resolution"], ["1", "2"], "name_location_match", "matched", ["x"], "ab"), row("", [], ["1", "2"], "no_match", "no_match", ["x", "y", "z"]), row("abcde", ["merged"] * 5, ["1", "2", "3"], "ambiguous", "ambiguous", [], "abc"), row("a", ["other", "default_value"], ["1"], "?", "?", [])]
    found = [tuple(r["confidence"][s] for s in confidence.SCORES) for r in confidence.assess(spark.createDataFrame(rows, schema)).collect()]
    assert [f[0] for f in found] == [0.6, 0.8, 0.0, 1.0, 0.6]
    assert [f[1] for f in found] == [1.0, 0.8, 0.0, 0.7, 0.4]
    assert [f[2] for f in found] == [0.8, 0.8, 1.0, 0.6, 0.8]
    assert [f[3] for f in found] == [1.0, 0.8, 0.6, 0.3, 0.5]
    assert [f[4] for f in found] == [1.0, 0.9, 1.0, 0.8, 0.5]
    assert [f[5] for f in found] == [0.12] * 2 + [0.0] + [0.12] * 2 and [f[6] for f in found] == [1.0, 0.8, 0.6, 0.3, 1.0]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_split_and_matched_once(spark):
    """Work in a list function isn't repeated for each word: the plan names each split and match once."""
    df = spark.createDataFrame([("He left Acme Labs in Lyon, France",)], "t string").select(F.array("t").alias("s"))
    assert _plan(df.select(extract_text.organizations(F.col("s")).alias("x"))).count("split(") == 1
    assert _plan(df.select(extract_text.place_mentions(F.col("s")).alias("x"))).count("split(") == 1
    assert _plan(df.select(F.transform("s", X.clean).alias("x"))).count("regexp_replace(") == 1
    row = df.select(extract_text.organizations(F.col("s")).alias("o"), extract_text.place_mentions(F.col("s")).alias("p")).first()
    assert (row.o, row.p) == (["Acme Labs"], ["Lyon France"])


def test_distinct_of_long_lists_keeps_first_items_in_order(spark):
    items = [f"{'aA'[k % 2]}{k * 7919 % 1500}" for k in range(4000)] + [None, "", "ΣΊΣ", "σίς"]
    kept = {}
    for x in items:
        if x:
            kept.setdefault(x.lower(), x)
    found = spark.createDataFrame([(items,)], "a array<string>").select(X.distinct(F.col("a"))).first()[0]
    assert found[:1500] == list(kept.values())[:1500] and len(found) in (len(kept), len(kept) + 1)

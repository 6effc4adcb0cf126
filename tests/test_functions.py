import random

import pytest
from pyspark.sql import functions as F

from matchloom.functions import addresses, names
from matchloom.functions.phonetic import metaphone, phonetic
from matchloom.functions.scripts import detect_script, harvard_kyoto, transliterate
from matchloom.functions.unicode import clean, roman_search


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


NAMES = {
    "Acme Pvt/Ltd.": "acme private limited",
    "A/B & C+D": "a and b and c and d",
    "Foo L.L.C.": "foo limited liability company",
    "Foo l. l. p": "foo limited liability partnership",
    "Co-op Inc": "company op incorporated",
    "foo\nbar": "foobar",
    "ﬁrst": "first",
    "Café & Söhne": "café and söhne",
    "Private & Limited": "private limited",
    "": "",
    None: "",
}


def test_normalize_name(spark):
    assert column(spark, NAMES, names.normalize_name) == list(NAMES.values())


ADDRESSES = [
    ("12 Main Street; Springfield, IL 62704", "US", ("12", "62704", "main street", "", "springfield", "il", "12|62704")),
    ("1 Elm Ave, Reno NV 12345-6789", "US", ("1", "6789", "elm ave", "", "reno nv 12345-", "", "1|12345-6789")),
    ("12 Main Street", "US", ("12", "", "main street", "12 main street", "", "", "12")),
    ("45, 12th Street, Pune", "India", ("45", "", "h street", "", "12th street", "pune", "45")),
    ("5 Rue X, Paris, France", "France", ("5", "", "rue x", "", "paris", "", "5")),
    (None, None, ("", "", "", "", "", "", "")),
    ("", "US", ("", "", "", "", "", "", "")),
]


@pytest.mark.parametrize("case", range(7))
def test_parse_address(spark, case):
    raw, country, expected = ADDRESSES[case]
    df = spark.createDataFrame([(raw, country, "kept")], "raw string, country string, address_city string")
    row = addresses.with_address(df.withColumn("a", addresses.normalize_address(F.col("raw"))), "a", "country").first()
    got = tuple(row[f"address_{k}"] for k in ("house_number", "postal_code", "street", "locality", "city", "state_region", "numeric_tokens"))
    assert got == expected


def test_address_counts(spark):
    df = spark.createDataFrame([("12 main street, springfield, il 62704", "US")], "a string, country string")
    row = addresses.with_address(df, "a", "country").first()
    assert (row.address_tokens, row.address_token_count, row.address_char_length) == ("12|main|street,|springfield,|il|62704", 6, 32)


SCRIPTS = {"": "Empty", None: "Empty", "  ": "Empty", "Acme": "Latin", "123": "Other", "Привет": "Other", "Acme Привет": "Latin", "राम": "Devanagari", "राम A": "Devanagari", "राम Ltd": "Mixed", "aक": "Latin", "কলকাতা": "Bengali"}


def test_detect_script(spark):
    assert column(spark, SCRIPTS, detect_script) == list(SCRIPTS.values())


def test_transliterate(spark):
    assert column(spark, ["राम", "Acme", "राम Ltd", None, "Привет", "कर्म"], transliterate) == ["rAma", "Acme", "rAma Ltd", None, "Привет", "karma"]
    assert harvard_kyoto("मार्केटिंग", "Devanagari") == "mArkeTiMga"


def test_roman_search(spark):
    assert column(spark, ["  Crème   Brûlée ", None, "ABC"], roman_search) == ["creme brulee", None, "abc"]


def test_clean_drops_controls(spark):
    assert column(spark, ["A​B\tC", None], clean) == ["abc", ""]


@pytest.mark.parametrize("word, code", [("thomas", "0MS"), ("knight", "NT"), ("school", "SKL"), ("phone", "FN"), ("wright", "RT"), ("xavier", "SFR"), ("church", "XRX"), ("lamb", "LM"), ("edge", "EJ")])
def test_metaphone(word, code):
    assert metaphone(word) == code


def test_phonetic_joins_codes(spark):
    assert column(spark, ["acme corp", "café", "", None], phonetic) == ["AKM|KRP", "KF", "", ""]


def test_name_structure_against_plain_python(spark):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcé1-&") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 4))) for _ in range(40)]
    assert column(spark, texts, names.token_string) == ["|".join(t.split()) for t in texts]
    assert column(spark, texts, names.compact) == ["".join(c for c in t if c.isalnum()) for t in texts]
    assert column(spark, texts, names.first_token) == [(t.split() or [""])[0] for t in texts]
    assert column(spark, texts, names.last_token) == [(t.split() or [""])[-1] for t in texts]
    assert column(spark, texts, names.token_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, names.char_length) == [len(t.replace(" ", "")) for t in texts]
    assert column(spark, ["क्षA1-"], names.compact) == ["कषA1"]


def test_python_sees_what_needs_it_and_each_value_once(spark, monkeypatch):
    import pyarrow as pa

    from matchloom.functions import unicode

    seen = []
    got = unicode.of_distinct(pa.array(["é", None, "a", "é", "é"]), lambda v: seen.append(v) or v * 2, pa.string())
    assert got.to_pylist() == ["éé", None, "aa", "éé", "éé"] and sorted(seen) == ["a", "é"]
    assert unicode.of_distinct(pa.array([], pa.string()), str, pa.string()).to_pylist() == []
    # plain rows are null in what is sent
    df = spark.createDataFrame([("plain",), ("ｆull",), (None,), ("राम",)], "t string")
    plan = df.select(unicode.nfkc(F.col("t")).alias("n"))._jdf.queryExecution().toString()
    assert "octet_length" in plan
    assert column(spark, ["plain", "ｆull", None, "ﬁ"], unicode.nfkc) == ["plain", "full", None, "fi"]


def test_address_columns_of_any_name(spark):
    names = [*addresses.STEPS, "_A_given", "address_given"]
    df = spark.createDataFrame([("12 main street, pune", "india", *names)], ", ".join(f"`{c}` string" for c in ["address", "country", *names]))
    row = addresses.with_address(df, "address", "country").first()
    assert all(row[c] == c for c in names) and row.address == "12 main street, pune" and row.address_city == "pune"
    own = addresses.with_address(df.withColumnsRenamed({"address": "_p2"}).drop("_p").withColumnsRenamed({"_p2": "_p"}), "_p", "country").first()
    assert own._p == "12 main street, pune" and own.address_street == "main street"


def test_scripts_are_told_in_few_passes(spark):
    """No list of a text's letters is made, and a script that is known is not looked for again."""
    df = spark.createDataFrame([("abcde कखग " * 500,), ("क" * 6 + "ab" * 3,), ("ab" * 3 + "ক" * 6,), ("ªº कa",)], "t string")
    told = df.select(detect_script(F.col("t")).alias("s"), transliterate(F.col("t"), F.lit("Latin")).alias("r"), "t")
    rows = told.collect()
    assert [r.s for r in rows] == ["Mixed", "Mixed", "Mixed", "Devanagari"] and all(r.r == r.t for r in rows)
    assert "regexp_count" not in told._jdf.queryExecution().analyzed().toString().lower() and "regexp_extract_all" not in told._jdf.queryExecution().optimizedPlan().toString().lower()

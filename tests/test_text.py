from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.redact import keeps_digit_run, redact
from corpusloom.operators.features import feature_frame, from_python
from corpusloom.operators.samples import redact_column, safe_sample

CASES = {
    "char_length": [("", 0), (None, 0), ("a b", 3), ("naïve 😀", 7)],
    "word_count": [("", 0), ("   ", 0), (" one  two\tthree\n", 3), ("a b c", 3), ("x\x1cy", 2)],
    "mean_word_length": [("", 0.0), ("ab abcd", 3.0), ("  ", 0.0)],
    "digit_count": [("a1b22", 3), ("²³", 2), ("٣٤", 2), ("①", 1), ("½", 0), ("", 0)],
    "digit_ratio": [("12ab", 0.5), ("", 0.0)],
    "uppercase_ratio": [("ABcd", 0.5), ("12!", 0.0), ("ÉÀx", 2 / 3), ("漢A", 0.5)],
    "all_caps_word_count": [
        ("WIN a PRIZE now", 2), ("I am", 0), ("U2 B2B", 1), ("!!FREE!! c4SH", 1), ("ÉTÉ", 1), ("漢AB", 0), ("A1B x", 1), ("GO ON", 2),
    ],
    "exclamation_count": [("hi!!", 2), ("", 0)],
    "currency_symbol_count": [("£5 $6 €7 ₿8", 3), ("GBP", 0)],
    "non_alnum_count": [("a.b, c!", 3), ("_-", 2), ("½²", 0), ("  ", 0), ("é漢", 0), ("😀", 1)],
    "has_url_like": [
        ("see HTTP://x", 1), ("WWW.site", 1), ("go to shop.co.uk!", 1), ("a--.com", 1), ("-.com", 0), ("--a.net", 1), (".com", 0),
        ("shop.common", 0), ("shop.com_", 0), ("é.org", 1), ("end of it.then", 0), ("http:/x", 0), ("x.TV", 1), ("", 0), ("ftp://x", 0),
    ],
    "has_long_digit_run": [("12345678", 1), ("1234567 8", 0), ("x٠١٢٣٤٥٦٧", 1)],
}


@pytest.mark.parametrize("name", list(CASES))
def test_feature_values(column, name):
    values, wanted = zip(*CASES[name])
    assert column(T.FEATURES[name], values) == pytest.approx(list(wanted))


def reference_words(text):
    return [w for w in text.split()]


def test_features_agree_with_plain_python_on_odd_text(column):
    texts = ["Ünïcode ÇA VA? 42", "tab\tNEW\nLINE \x85next", "A.B.C 9-9 $", "ÀÉ Zz 1234567890 x", "a​b C​D"]
    assert column(T.word_count, texts) == [len(reference_words(t)) for t in texts]
    assert column(T.digit_count, texts) == [sum(c.isdigit() for c in t) for t in texts]
    assert column(T.non_alnum_count, texts) == [sum(not c.isalnum() and not c.isspace() for c in t) for t in texts]
    caps = [
        sum(1 for w in t.split() if len([c for c in w if c.isalpha()]) > 1 and all(c.isupper() for c in w if c.isalpha()))
        for t in texts
    ]
    assert column(T.all_caps_word_count, texts) == caps


def test_feature_frame_contract(spark):
    df = spark.createDataFrame([(1, "WIN £100 now!"), (2, "see you"), (3, ""), (4, None)], "id int, t string")
    frame = feature_frame(df, "t", ["id"])
    assert frame.columns == ["id", *T.FEATURE_NAMES]
    assert {f.dataType.typeName() for f in frame.schema.fields[1:]} == {"double"}
    rows = {r["id"]: r for r in frame.collect()}
    assert all(v is not None for r in rows.values() for v in r)
    assert all(v == 0.0 for v in rows[4][1:]) and all(v == 0.0 for v in rows[3][1:])
    with pytest.raises(KeyError):
        feature_frame(df, "absent")


def test_numbers_count_as_text_and_nan_as_empty(spark):
    df = spark.createDataFrame([(12.5,), (float("nan"),)], "v double")
    lengths = [r["char_length"] for r in feature_frame(df, "v").collect()]
    assert lengths == [4.0, 0.0]


def test_user_function(spark):
    df = spark.createDataFrame([("aXbX",), (None,)], "t string")
    count_x = from_python(lambda t: 0.0 if t is None else float(t.count("X")))
    assert [r["x"] for r in feature_frame(df, "t", features={"x": count_x}).collect()] == [2.0, 0.0]


REDACTED = [
    ("write to ann.lee+x@mail.example.com now", "write to <EMAIL> now"),
    ("a@b.c-d@e.f", "<EMAIL><EMAIL>"),
    ("go https://a.b/c?d=1, or WWW.site.tv/x", "go <URL> or <URL>"),
    ("ring +44 7911-123456 or 80-82-84", "ring <PHONE> or <PHONE>"),
    ("code 12345 and 123456", "code <NUM> and <PHONE>"),
    ("pay £1,000 or $ 5.50 or 7.25", "pay <MONEY> or <MONEY> or <NUM>"),
    ("12.5abc abc12 é12 12", "<NUM>.5abc abc12 é12 <NUM>"),
    ("Ask Maria or Call Tom. Monday? McDonald", "<NAME> <NAME> or Call <NAME>. Monday? McDonald"),
    ("  many \n\t spaces here ", "many spaces here"),
    ("Don't", "<NAME>'t"),
    (None, ""),
]


def test_redaction(column):
    values, wanted = zip(*REDACTED)
    got = column(lambda c: redact(c, max_chars=500), values)
    assert got == list(wanted)


def test_redaction_truncates_last(column):
    long = "word " * 40 + "07911 123456"
    (short,) = column(redact, [long])
    assert len(short) <= 70 and short.endswith("…") and not short[:-1].endswith(" ")
    assert column(lambda c: redact(c, max_chars=10**6), [long]) == ["word " * 40 + "<PHONE>"]
    assert column(lambda c: redact(c, names=False), ["Maria 5"]) == ["Maria <NUM>"]


def test_no_three_digit_run_survives(column):
    texts = ["call 0791 123 4567", "pin 1234", "£12345", "ref A-998", "www.x.com/12345", "mail bob99999@x.com"]
    shown = column(redact, texts)
    assert column(keeps_digit_run, shown) == [False] * len(texts)


def test_sampling(spark):
    df = spark.createDataFrame([(i, "ab"[i % 5 == 0], f"Hello {i * 1000}") for i in range(40)], "id int, g string, t string")
    grouped = safe_sample(df, "id", "t", n=3, group="g").collect()
    assert sorted(r["g"] for r in grouped) == ["a"] * 3 + ["b"] * 3
    assert len(safe_sample(df, "id", "t", n=100, group="g").collect()) == 40
    again = safe_sample(df, "id", "t", n=5).collect()
    assert again == safe_sample(df, "id", "t", n=5).collect() and len(again) == 5
    assert safe_sample(df, "id", "t", n=5, seed=7).collect() != again
    assert df.filter(F.col("t").contains("<")).count() == 0
    with pytest.raises(KeyError):
        redact_column(df, "absent")

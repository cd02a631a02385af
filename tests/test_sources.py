from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import corpora as C
from corpusloom.sources.text_files import (
    EXTENDED_ENCODINGS,
    EncodingDetectionError,
    detect_encodings,
    read_delimited,
    read_lines,
    read_messages,
)


@pytest.fixture
def latin1(tmp_path):
    path = tmp_path / "latin1.csv"
    path.write_bytes(b"label,message\nham,\xa35 caf\xe9\nspam,se\xf1or\nham,m\xeds\n")
    return str(path)


@pytest.fixture
def utf8(tmp_path):
    path = tmp_path / "utf8.csv"
    path.write_bytes("label,message\nham,£5\nspam,café\n".encode())
    return str(path)


def test_ladder_falls_back_and_reports(spark, latin1):
    loaded = read_delimited(spark, latin1)
    assert [r.message for r in loaded.data.collect()] == ["£5 café", "señor", "mís"]
    p = loaded.provenance.first()
    assert (p.n_rows, p.n_columns, p.encoding, p.used_fallback) == (3, 2, "latin-1", True)
    assert p.attempted == ["utf-8", "latin-1"]


def test_utf8_is_first_choice(spark, utf8):
    p = read_delimited(spark, utf8).provenance.first()
    assert (p.encoding, p.used_fallback, p.attempted) == ("utf-8", False, ["utf-8"])
    assert not p.used_fallback


def test_mixed_files_are_read_each_in_its_own_encoding(spark, latin1, utf8):
    loaded = read_delimited(spark, [latin1, utf8])
    assert sorted(r.message for r in loaded.data.collect()) == sorted(["£5 café", "señor", "mís", "£5", "café"])
    assert loaded.data.filter(F.col("message").contains("�")).count() == 0
    assert {r.encoding: r.n_rows for r in loaded.provenance.collect()} == {"latin-1": 3, "utf-8": 2}
    lines = read_lines(spark, [latin1, utf8]).filter(F.col("line").startswith("ham"))
    assert {r.line for r in lines.collect()} == {"ham,£5 café", "ham,mís", "ham,£5"}


def test_types_fit_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,word\n1,é\n2,ü\n".encode("latin-1"))
    (tmp_path / "b.csv").write_text("id,word\nA-7,日本\nB-8,x\n")
    (tmp_path / "c.csv").write_bytes(b"")
    loaded = read_delimited(spark, str(tmp_path))
    assert {r.id for r in loaded.data.collect()} == {"1", "2", "A-7", "B-8"}
    assert sorted(r.n_rows for r in loaded.provenance.collect()) == [0, 2, 2]
    (tmp_path / "d.csv").write_text("id,other\n日,x\n")
    (tmp_path / "b.csv").unlink()
    with pytest.raises(ValueError, match="headers differ"):
        read_delimited(spark, str(tmp_path))


def test_windows_1252(spark, tmp_path):
    path = tmp_path / "win.csv"
    path.write_bytes(b"a\nit\x92s here\n")
    assert read_delimited(spark, str(path)).provenance.first().encoding == "latin-1"
    loaded = read_delimited(spark, str(path), EXTENDED_ENCODINGS)
    assert loaded.data.first().a == "it’s here" and loaded.provenance.first().encoding == "cp1252"
    assert [r.line for r in read_lines(spark, str(path), EXTENDED_ENCODINGS).orderBy("position").collect()] == ["a", "it’s here"]
    undefined = tmp_path / "undefined.csv"
    undefined.write_bytes(b"a\nx\x81\xe9\n")
    assert detect_encodings(spark, str(undefined), EXTENDED_ENCODINGS).first().encoding == "latin-1"


def test_byte_order_mark_is_dropped(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes("a,b\n1,é\n".encode("utf-8-sig"))
    assert read_delimited(spark, str(path)).data.columns == ["a", "b"]
    assert read_lines(spark, str(path)).orderBy("position").first().line == "a,b"


def test_headerless_messages_keep_bare_quotes(spark, tmp_path):
    path = tmp_path / "messages.tsv"
    path.write_bytes(b'ham\t"quoted start\nspam\twin \xa3100 "now"\n')
    data = read_messages(spark, str(path)).data
    assert sorted(map(tuple, data.collect())) == [("ham", '"quoted start'), ("spam", 'win £100 "now"')]


def test_types_are_inferred_without_a_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,y\n")
    assert [f.dataType.typeName() for f in read_delimited(spark, str(path)).data.schema.fields] == ["integer", "string"]


def test_contract_errors(spark, utf8, latin1):
    with pytest.raises(ValueError):
        read_delimited(spark, utf8, encoding="utf-8")
    with pytest.raises(ValueError):
        read_delimited(spark, utf8, ())
    with pytest.raises(ValueError):
        read_lines(spark, utf8, ("ebcdic",))
    with pytest.raises(FileNotFoundError):
        read_delimited(spark, utf8 + ".missing")
    with pytest.raises(EncodingDetectionError):
        read_lines(spark, latin1, ("utf-8", "ascii"))


def test_corpora(spark):
    big = spark.createDataFrame(
        [(1, 1, "long enough"), (2, 1, "long enough"), (3, 0, "long enough"), (4, 2, "other label"), (5, 0, "tiny"), (6, 0, None)],
        "id int, label int, text string",
    )
    assert sorted(r.id for r in C.hygiene(big, "id").collect()) == [1, 3]
    mail = spark.createDataFrame([("Hi", None, "spam"), (None, "body", "ham")], "Subject string, Message string, `Spam/Ham` string")
    phish = spark.createDataFrame([(None, "Safe Email"), ("text", "Phishing Email")], "`Email Text` string, `Email Type` string")
    stacked = C.union_corpora(
        {
            "big": C.large_corpus(big, "id"),
            "mail": C.email_corpus(mail),
            "phish": C.phishing_corpus(phish),
            "gone": C.optional(lambda: C.large_corpus(spark.read.csv("/no/such/file.csv"), "id")),
        }
    )
    assert sorted((r.corpus, r.text, r.y) for r in stacked.collect()) == [
        ("big", "long enough", 0), ("big", "long enough", 1), ("mail", " body", 0), ("mail", "Hi ", 1), ("phish", "text", 1),
    ]
    with pytest.raises(ValueError):
        C.union_corpora({"gone": None})


def test_files_with_line_breaks_stay_small(spark, monkeypatch):
    """s1_types_of_all_files: a reader takes such files whole, so more rows make more files."""
    from corpusloom.catalogue import QUERIES, sources

    monkeypatch.setattr(sources, "FILE_ROWS", 20)
    folder = "/root/testdata/sf0.001"
    assert QUERIES["s4_provenance"](spark, folder).agg(F.max("n_rows")).first()[0] <= 20
    want = spark.read.parquet(f"{folder}/documents.parquet").select(F.md5("text")).collect()
    assert sorted(QUERIES["s1_types_of_all_files"](spark, folder).select("digest").collect()) == sorted(want)

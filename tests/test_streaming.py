from __future__ import annotations

from corpusloom.functions.text import FEATURE_NAMES
from corpusloom.streaming.stateless import featurise, parse_log_stream, redact_stream, text_stream


def drain(stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return stream.sparkSession.table(name).collect()


def test_row_wise_operators_run_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("10:00 [ERROR] a.b - failed after 5ms\nWIN £100 now!\n")
    source = text_stream(spark, str(tmp_path / "in"))
    features = drain(featurise(source, keep=["value"]), "features")
    assert len(features) == 2 and features[0].asDict().keys() == {"value", *FEATURE_NAMES}
    shown = {r.value for r in drain(redact_stream(source), "shown")}
    assert "WIN <MONEY> now!" in shown
    parsed = {r.level: r.template for r in drain(parse_log_stream(source), "parsed")}
    assert parsed == {"ERROR": "failed after <N>ms", None: None}

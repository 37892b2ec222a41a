"""Row-level feature functions apply unchanged to a streaming DataFrame."""

from gridcast.functions.calendar import calendar_features
from gridcast.functions.weather import physics_features, weather_features
from gridcast.operators.clean import clip_rules, inf_to_null


def test_row_features_on_stream(spark, sf001, tmp_path):
    from gridcast.sources import fixtures as fx

    batch = fx.weather_hour(spark, sf001)
    src = str(tmp_path / "src")
    batch.write.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    out = clip_rules(inf_to_null(physics_features(weather_features(calendar_features(stream)))))
    q = out.writeStream.format("memory").queryName("wx_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("wx_stream")
    exp = clip_rules(inf_to_null(physics_features(weather_features(calendar_features(batch)))))
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0

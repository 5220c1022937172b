from pyspark.sql import functions as F

from crestline.streaming.incremental import grow_groups, histogram_stream, score_stream, stream_table

SCHEMA = "domain string, logo_url string, source_strategy string, extracted_at timestamp"


def test_streams(small, tmp_path):
    rows = [("a", "https://a.test/logo.svg", "img_tag"), ("b", "https://a.test/cart.png", "img_tag"), ("c", None, "link_tag")]
    df = small.createDataFrame(rows, "domain string, logo_url string, source_strategy string").withColumn("extracted_at", F.timestamp_micros(F.lit(1_767_225_600_000_000)))
    df.write.parquet(str(tmp_path / "in"))
    source = stream_table(small, str(tmp_path / "in"), SCHEMA)
    q = score_stream(source).writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.domain, r.url_score) for r in small.table("scored").collect()] == [("a", 60)]
    q = histogram_stream(source).writeStream.outputMode("complete").format("memory").queryName("histogram").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {r.source_strategy: r.n for r in small.table("histogram").collect()} == {"img_tag": 2, "link_tag": 1}


def test_groups_grow(small, tmp_path):
    for no, edges in enumerate(([("a", "b"), ("c", "d")], [("b", "c"), ("x", "y")])):
        small.createDataFrame(edges, "src string, dst string").coalesce(1).write.mode("append").parquet(str(tmp_path / "edges"))
        grow_groups(stream_table(small, str(tmp_path / "edges"), "src string, dst string"), str(tmp_path / "store"), str(tmp_path / "ck")).awaitTermination(120)
    got = {r.node: r.component for r in small.read.parquet(str(tmp_path / "store/1")).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}

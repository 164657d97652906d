import math
import os

from sensorweave import catalog
from sensorweave.streaming.karas_stream import karas_stream, start_parquet_sink
from tests import raw_layouts


def test_karas_stream_matches_batch_rules(spark, tmpdir_path):
    src = raw_layouts.karas(tmpdir_path)
    flat = os.path.join(tmpdir_path, "flat")
    os.makedirs(flat)
    # the stream reads one folder; use the first file's layout
    with open(os.path.join(src, "id00b70b13.csv")) as fh:
        body = fh.read()
    with open(os.path.join(flat, "id00b70b13.csv"), "w") as fh:
        fh.write(body)
    stream = karas_stream(spark, flat, ["activity", "time_s", "lw_x", "lw_y", "lw_z"])
    assert stream.isStreaming
    out = os.path.join(tmpdir_path, "out")
    q = start_parquet_sink(stream, out, name="karas-test",
                           checkpoint=os.path.join(tmpdir_path, "ckpt"), available_now=True)
    q.awaitTermination(120)
    rows = sorted(spark.read.parquet(out).collect(), key=lambda r: r.time_ms)
    assert [r.time_ms for r in rows] == [500, 2009, 3000]
    assert [r.surface for r in rows] == ["flat", "stairs_up", None]
    assert rows[1].lw_y is None and math.isclose(rows[1].lw_x, catalog.STANDARD_GRAVITY)
    assert {r.sid for r in rows} == {"id00b70b13"}

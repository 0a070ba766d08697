"""Day versions as a stream: files in any order, timers, restarts."""

import random
from datetime import date, datetime, timedelta

import pytest

from quarterlake.operators import versions
from quarterlake.schema import MANIFEST
from quarterlake.sources import snapshots
from quarterlake.streaming import versions as flow

FIRST, LAST, TODAY = date(2025, 1, 1), date(2025, 2, 20), date(2025, 2, 25)


def files(r, n=70):
    out = []
    for i in range(n):
        d = FIRST + timedelta(r.randrange(51))
        kind = r.choice(["def", "def", "pre", "pre", "pre", "desconocido" if r.random() < 0.3 else "pre"])
        out.append((d, kind, r.choice([1, 1, 2, None]), r.randrange(2), r.choice([None, d + timedelta(r.randrange(30))]), f"f{i}"))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_any_order_gives_the_same_days(spark, tmp_path, seed):
    r = random.Random(seed)
    held = files(r)
    source, root, checkpoint = str(tmp_path / "in"), f"file://{tmp_path}/out", f"file://{tmp_path}/check"
    clock = datetime(2025, 2, 1)
    stream = lambda: spark.readStream.schema(flow.EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    flow.ticks(spark, FIRST, LAST, datetime(2025, 1, 1)).coalesce(1).write.mode("append").parquet(source)
    for part in (held[:30], held[30:33], held[33:]):
        clock += timedelta(days=4)
        rows = [(*x, clock) for x in part]
        r.shuffle(rows)
        spark.createDataFrame(rows, flow.EVENTS).coalesce(1).write.mode("append").parquet(source)
        flow.track(stream(), root, checkpoint)
    flow.ticks(spark, LAST, LAST, datetime(TODAY.year, TODAY.month, TODAY.day)).coalesce(1).write.mode("append").parquet(source)
    flow.track(stream(), root, checkpoint)
    known = flow.known_days(spark, root)
    manifest = spark.createDataFrame([("u", n, k, v, i, d, p, "s", 1, None) for d, k, v, i, p, n in held], "url string, nombre string, tipo string, version int, reemision int, fecha_operacion date, fecha_publicacion date, sha256 string, bytes bigint, descargado_en string")
    want = versions.choose_by_day(manifest, None).select("fecha_operacion", "nombre", "tipo", "version", "reemision", "fecha_publicacion")
    assert flow.chosen_days(known).collect() == want.collect() and want.count() > 10 and MANIFEST
    doubtful = {x["fecha_operacion"] for x in versions.doubtful_days(manifest).collect()}
    assert {x["fecha_operacion"] for x in known.where("dudoso").collect()} == doubtful
    late = versions.completeness(manifest, FIRST, LAST, TODAY)
    assert [tuple(x) for x in flow.overdue(known).select("estado", "desde", "hasta", "dias").collect()] == [tuple(x) for x in late.select("estado", "desde", "hasta", "dias").collect()]
    assert {x["estado"] for x in late.collect()} == {"sin_archivo", "pre_sin_definitivo"}
    before = snapshots.versions(spark, root)
    flow.track(stream(), root, checkpoint)
    assert snapshots.versions(spark, root) == before and flow.known_days(spark, root).count() == 51


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    row = (FIRST, "a", "def", 1, 0, None, False, None, 0)
    batch = spark.createDataFrame([row, (*row[:7], "x", 1)], f"{flow.DAYS}, paso int")
    flow.merge_days(root)(batch, 3)
    flow.merge_days(root)(batch, 3)
    assert snapshots.versions(spark, root) == [1] and [x["alarma"] for x in flow.known_days(spark, root).collect()] == ["x"]

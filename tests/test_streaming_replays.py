import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from terroir.operators import lifecycle as L
from terroir.streaming import replays as R

SCHEMA = "ticket string, fecha timestamp, seq long, estado_solicitado string"
FLUSH = ("zz", datetime(2027, 1, 1), 99_999, "EN_PROCESO")


def run(spark, tmp, files, name, **kw):
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
        q = R.replay_stream(spark, stream, "ticket", L.TICKET, "ABIERTO", f"{tmp}/out", f"{tmp}/dead", name, **kw)
        q.awaitTermination()                                   # each file: the query starts again from its checkpoint
        assert q.exception() is None, i
    return spark.read.parquet(f"{tmp}/out"), spark.read.schema(R.OUTPUT).parquet(f"{tmp}/dead")


def test_stream_equals_batch(spark, tmp):
    rnd = random.Random(6)
    start = datetime(2026, 6, 1)
    rows = [(f"t{rnd.randrange(5)}", start + timedelta(minutes=20 * i + rnd.randrange(3)), i, rnd.choice([*L.TICKET, "x", None])) for i in range(240)]
    first, second = rows[:130], rows[130:]
    shuffled = [*first[:100], *second[:5], *first[100:]]
    rnd.shuffle(shuffled)                                      # out of order, within the delay
    late = ("t1", start + timedelta(minutes=1), 5_000, "CERRADO")
    files = [shuffled + shuffled[:40], [*second[5:], *first[-3:]], [FLUSH, late]]
    out, dead = run(spark, tmp, files, f"replay-{id(tmp)}", delay="2 days")
    batch = L.replay(spark.createDataFrame(rows, SCHEMA), "ticket", ["fecha", "seq"], "estado_solicitado", L.TICKET, "ABIERTO")
    cols = ["seq", "estado_solicitado", "estado_anterior", "estado", "veredicto", "paso"]
    assert sorted(map(str, out.select("clave", *cols).collect())) == sorted(map(str, batch.select(F.col("ticket").alias("clave"), *cols).collect()))
    assert {r.seq for r in dead.collect()} == {5_000} and dead.where("marca IS NULL").count() == 0
    sla = L.ticket_sla(spark.createDataFrame(rows, SCHEMA), replayed=out.withColumnRenamed("clave", "ticket"))
    assert sorted(map(str, sla.collect())) == sorted(map(str, L.ticket_sla(spark.createDataFrame(rows, SCHEMA)).collect()))


def test_idle_keys_are_forgotten(spark, tmp):
    d = lambda n: datetime(2026, 6, n)
    files = [[("a", d(1), 1, "CERRADO"), ("b", d(9), 2, "CERRADO")], [("b", d(20), 3, "REABIERTO"), ("c", d(21), 4, "CERRADO")],
             [("a", d(25), 5, "CERRADO"), ("b", d(23), 6, "CERRADO")], [FLUSH]]
    out, _ = run(spark, tmp, files, f"idle-{id(tmp)}", delay="1 day", idle_days=5)
    got = {r.seq: (r.estado_anterior, r.veredicto) for r in out.collect()}
    assert got[5] == ("ABIERTO", L.APPLIED)                    # forgotten: starts anew
    assert got[6][0] == "REABIERTO"                            # still held

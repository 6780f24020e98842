"""Envelopes with drifting columns, even ranges, bronze jobs and the newer spec steps and loads."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from change_log import LOG_SCHEMA, literal_rows
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType

from tidemark.operators import merge_current, normalize_envelope, normalize_envelope_evolving
from tidemark.operators.envelope import DEFAULT_FIELDS
from tidemark.operators.evolving import common_type
from tidemark.plans import raw_to_bronze, run_spec
from tidemark.sinks import write_files
from tidemark.sources import even_ranges, read_jdbc_snapshot, read_ranges
from tidemark.streaming import write_change_stream


def frame(spark, messages):
    return spark.createDataFrame([(m if m is None or isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


def message(image, op="c", ms=1000, wrap=False, before=None):
    body = {"op": op, "after": image, "before": before, "source": {"ts_ms": ms, "lsn": ms}}
    return {"payload": body} if wrap else body


def test_every_value_of_drifting_images_stays(spark):
    images = [{"id": 1, "n": 1, "a b": "x"}, {"id": "two", "n": 2.5, "o": {"q": [1, 2]}}, {"id": 3, "n": 10**12, "o": None, "t": True},
              {"id": 4, "o": "text", "t": False, "only": None}, {"id": 5, "d": 1.25, 'q"q': "quoted"}]
    rows = [message(x, wrap=i % 2 == 0, ms=i) for i, x in enumerate(images)]
    good, bad, fields = normalize_envelope_evolving(frame(spark, rows))
    types = {f.name: f.dataType.simpleString() for f in fields}
    assert types == {"id": "string", "n": "decimal(21,1)", "a b": "string", "o": "string", "t": "boolean", "only": "string", "d": "decimal(3,2)", 'q"q': "string"}
    got = {r["id"]: r for r in good.collect()}
    assert bad.count() == 0 and got.keys() == {"1", "two", "3", "4", "5"}
    assert float(got["two"]["n"]) == 2.5 and int(got["3"]["n"]) == 10**12 and json.loads(got["two"]["o"]) == {"q": [1, 2]}
    assert got["4"]["o"] == "text" and got["3"]["o"] is None and got["1"]["a b"] == "x" and got["5"]['q"q'] == "quoted"
    assert got["3"]["t"] is True and got["4"]["only"] is None


def test_fields_only_widen_over_batches(spark):
    known, seen = None, []
    for images in ([{"id": 1, "n": 1}], [{"id": 2, "n": 1.5, "x": "a"}], [{"id": 3, "n": None}], [{"id": 4, "n": "many"}]):
        good, _, known = normalize_envelope_evolving(frame(spark, [message(i) for i in images]), known=known)
        seen.append({f.name: f.dataType.simpleString() for f in known})
        assert set(known.names) <= set(good.columns)
    assert [s["n"] for s in seen] == ["bigint", "decimal(20,1)", "decimal(20,1)", "string"] and "x" in seen[-1]
    assert common_type(LongType(), DecimalType(38, 30)) == StringType()


def test_it_rejects_what_the_fixed_schema_rejects(spark):
    image = {"id": "1", "name": "n", "email": "e"}
    rows = [message(image), message(image, wrap=True), message(None), "nope", None, message(image, op="t"), message(image, ms=None), message({"name": "x"}),
            message({"id": None}), message(None, op="d", before=image), message(image, op="d"), "[1]", "{}", message("text")]
    fixed = normalize_envelope(frame(spark, rows), fields=DEFAULT_FIELDS)
    loose = normalize_envelope_evolving(frame(spark, rows))
    cols = ["operation", "action", "id", "name", "email", "updated_timestamp", "partition_date"]
    assert sorted(map(str, fixed[0].select(cols).collect())) == sorted(map(str, loose[0].select(cols).collect()))
    rejected = lambda q: sorted(str(r["raw"]) for r in q.collect())
    assert rejected(fixed[1]) == rejected(loose[1]) and loose[1].where("reason IS NULL").count() == 0


def test_no_images_at_all(spark):
    good, bad, fields = normalize_envelope_evolving(frame(spark, ["nope"]), seq_field="lsn")
    assert good.count() == 0 and bad.count() == 1 and fields.names == ["id"] and "seq" in good.columns
    with pytest.raises(ValueError):
        normalize_envelope_evolving(frame(spark, [message({"id": 1, "action": "x"})]))


# --- even ranges ------------------------------------------------------------------------------------

def check_cover(table, predicates):
    total = table.count()
    counts = [table.where(p).count() for p in predicates]
    assert sum(counts) == total and read_ranges(table, predicates).drop("range").exceptAll(table).count() == 0
    return sorted(counts)


@pytest.mark.parametrize("seed", range(4))
def test_ranges_of_a_skewed_key_are_even(spark, seed):
    rnd = random.Random(seed)
    value = lambda: rnd.choice([7, 7, 7, None, int(rnd.paretovariate(0.5)) % 10**6, -rnd.randint(1, 10**6), rnd.randint(1, 100)])
    table = spark.createDataFrame([(i, value()) for i in range(6000)], "pk long, k long").cache()
    counts = check_cover(table, even_ranges(table, "k", 10, split_by="pk"))
    assert 8 <= len(counts) <= 16 and counts[-1] <= 2 * counts[len(counts) // 2]


def test_ranges_from_an_old_copy_cover_a_changed_table(spark):
    old = spark.createDataFrame([(i, 5 + i % 3) for i in range(300)], "pk long, k long")
    new = old.unionByName(spark.createDataFrame([(None, 5), (900, None), (901, -4), (902, 99), (-3, 6), (None, None)], "pk long, k long"))
    check_cover(new, even_ranges(old, "k", 4, split_by="pk"))


@pytest.mark.parametrize("kind, value", [("date", dt.date(2024, 1, 1)), ("timestamp_ntz", dt.datetime(2024, 1, 1, 5)), ("double", 0.5), ("decimal(9,2)", None)])
def test_ranges_of_other_types_and_small_tables(spark, kind, value):
    rows = spark.range(200).select(F.col("id").alias("pk"), (F.lit(value) + F.expr("CAST(id % 50 AS INT)") if kind == "double" else
                                   F.expr("CAST(id % 50 AS DECIMAL(9,2))") if value is None else
                                   F.expr("date_add(DATE '2024-01-01', CAST(id % 50 AS INT))") if kind == "date" else
                                   F.expr("timestampadd(HOUR, CAST(id % 50 AS INT), TIMESTAMP_NTZ '2024-01-01 05:00:00')")).alias("k"))
    counts = check_cover(rows, even_ranges(rows, "k", 5))
    assert counts[-1] <= 80
    for n in (1, 3):
        check_cover(rows.limit(2), even_ranges(rows.limit(2), "k", n))
        empty = even_ranges(rows.limit(0), "k", n)
        check_cover(rows, empty)
    with pytest.raises(ValueError):
        even_ranges(rows, "k", 0)
    with pytest.raises(ValueError):
        read_jdbc_snapshot(spark, "jdbc:x", "t", partition_column="k", predicates=["1 = 1"])


# --- bronze jobs, sinks, specs ------------------------------------------------------------------------

def test_raw_to_bronze_replaces_its_day_only(spark, scratch):
    rows = literal_rows([(1, 1, "INSERT", "2024-01-01 10:00:00"), (2, 2, "INSERT", "2024-01-02 10:00:00"), (3, 3, "INSERT", "2024-01-02 11:00:00")])
    raw = spark.createDataFrame(rows, LOG_SCHEMA).drop("partition_date")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02", "2024-01-09"):
        raw_to_bronze(spark, raw, f"{scratch}/a", as_of=day)
        raw_to_bronze(spark, raw, f"{scratch}/b", kind="snapshot", as_of=day)
    count = lambda p: {str(r[0]): r[1] for r in spark.read.parquet(p).groupBy("partition_date").count().collect()}
    assert count(f"{scratch}/a") == {"2024-01-01": 1, "2024-01-02": 2}
    assert count(f"{scratch}/b") == {"2024-01-01": 3, "2024-01-02": 3, "2024-01-09": 3}
    with pytest.raises(ValueError):
        raw_to_bronze(spark, raw, f"{scratch}/c", kind="full")


@pytest.mark.parametrize("sink", ["memory", "console"])
def test_inspection_sinks(spark, scratch, sink, capfd):
    spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1).write.text(f"{scratch}/in")
    stream = spark.readStream.text(f"{scratch}/in")
    query = write_change_stream(stream, "", f"{scratch}/ckpt", format=sink, query_name=f"seen_{sink}")
    query.awaitTermination()
    if sink == "memory":
        assert sorted(r[0] for r in spark.table("seen_memory").collect()) == ["a", "b"]
    assert query.exception() is None


def test_upkeep_loads_replace_the_table_they_read(spark, scratch):
    current = spark.createDataFrame([(k, f"n{k}", "e", "INSERT", dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31)) for k in (1, 2, 3)],
                                    "id long, name string, email string, action string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    batch = spark.createDataFrame(literal_rows([(1, 1, "UPDATE", "2024-01-02 10:00:00"), (2, 2, "DELETE", "2024-01-02 10:00:00"), (3, 9, "INSERT", "2024-01-02 10:00:00")]), LOG_SCHEMA)
    write_files(spark, current, f"{scratch}/cur")
    want = sorted(map(str, merge_current(current, batch).collect()))
    write_files(spark, batch, f"{scratch}/in")
    run_spec(spark, {"extract_dfs": {"c": {"type": "read_file", "file_path": f"{scratch}/in"}}, "load": {"c": {
        "type": "scd4_upkeep", "path_current": f"{scratch}/cur", "path_hist": f"{scratch}/hist", "tie": ["seq"], "load_id": 1}}}, as_of="2024-01-02")
    cols = ["id", "name", "email", "action", "valid_from", "valid_to"]
    assert sorted(map(str, spark.read.parquet(f"{scratch}/cur").select(cols).collect())) == want
    assert [r["id"] for r in spark.read.parquet(f"{scratch}/hist").collect()] == [2]


def test_each_part_of_an_envelope_is_taken_out_once(spark):
    message = '{"payload": {"op": "u", "after": {"id": 1, "name": "n"}, "source": {"ts_ms": 5}}}'
    good, bad, _ = normalize_envelope_evolving(spark.createDataFrame([(message,)], "value string"))
    for df in (good, bad):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("$.op,") == 1 and plan.count("$.source.ts_ms,") <= 1 and plan.count("$.after,") <= 1
        assert plan.count('$["id"],') <= 2   # as text and, where it has none, as JSON

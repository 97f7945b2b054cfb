"""Registered queries for JSON, change data, files, quality, governance, analytics and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import semantics as m
from millrace.functions.semantics import desc, ratio
from millrace.operators import analytics as an
from millrace.operators import governance as gv
from millrace.operators import layout as pd_
from millrace.operators import quality as dq
from millrace.operators import relational as r
from millrace.operators import semistructured as js
from millrace.operators import summaries as sm
from millrace.operators.relational import star_join, top_n, union_all
from millrace.plans.catalog.common import Source, plain, scratch
from millrace.sources import files
from millrace.streaming import changes as cd
from millrace.streaming import snapshots as sn

QUERIES = {}


def query(fn):
    """Register ``fn(source) -> DataFrame`` under its name."""
    QUERIES[fn.__name__] = lambda spark, folder: plain(fn(Source(spark, folder)))
    return fn


# ---- semi-structured ------------------------------------------------------------

def _order_documents(s):
    """One document per order with its lines; every line carries a small array."""
    lines = s.lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("qty"), F.array("l_returnflag", "l_linestatus").alias("extras")).alias("line"))
    docs = lines.groupBy("l_orderkey").agg(F.collect_list("line").alias("lines"))
    df = docs.join(s.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    body = F.struct(F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").alias("cust"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).alias("order"), F.col("lines").alias("vehicle"))
    return df.select(js.parse(F.to_json(body)).alias("src"))


@query
def json_path_cast(s):
    """Typed paths of the event properties; an absent path is NULL."""
    v = s.events.select("event_type", js.parse("props", strict=False).alias("v"))
    df = v.select("event_type", js.json_get("v", "k", "number").alias("k"), js.json_get("v", "k", "string").alias("text"), js.json_get("v", "a.b[0]", "string").alias("absent"))
    return df.groupBy("event_type").agg(F.sum("k").alias("sum_k"), F.max("k").alias("max_k"), F.max("text").alias("max_text"), F.count("absent").alias("absent"), F.count(F.lit(1)).alias("n"))


@query
def json_paths_deep(s):
    """Dotted, multi-colon and indexed paths of order documents."""
    d = _order_documents(s)
    return d.select(js.json_get("src", "order.id", "number").alias("id"), js.json_get("src", "order:cust", "number").alias("cust"), F.to_date(js.json_get("src", "order.date", "string")).alias("day"),
                    js.json_get("src", "vehicle[3].extras[1]", "string").alias("fourth"), js.json_get("src", "vehicle[0].extras[3]", "string").alias("never")) \
        .groupBy("day").agg(F.count("id").alias("n"), F.sum("cust").alias("cust"), F.count("fourth").alias("with_fourth"), F.count("never").alias("never"))


@query
def json_flatten(s):
    lines = js.flatten(_order_documents(s), "src", "vehicle", "line")
    return lines.groupBy(js.json_get("line", "l_partkey", "number").alias("part")).agg(F.sum(js.json_get("line", "qty", "number")).alias("quantity"), F.count(F.lit(1)).alias("n"))


@query
def json_flatten_nested(s):
    """An array inside an array, with the position of each element."""
    lines = js.flatten(_order_documents(s), "src", "vehicle", "line").select("line")
    extras = js.flatten(lines, "line", "extras", "extra", with_index="pos")
    return extras.groupBy("pos", F.col("extra").cast("string").alias("extra")).agg(F.count(F.lit(1)).alias("n"), F.sum(js.json_get("line", "qty", "number")).alias("quantity"))


@query
def object_nest_address(s):
    """Customers as documents with a nested address array."""
    df = star_join(s.customer, (s.nation, "c_nationkey", "n_nationkey"), (s.region, "n_regionkey", "r_regionkey"))
    nested = js.nest(df, ["c_custkey", "c_name"], ["n_name", "r_name"], "c_address")
    return nested.select(F.to_json(F.struct("c_address", "c_custkey", "c_name")).alias("customer"))


@query
def row_to_object(s):
    """Rows as objects; a field that is NULL is left out."""
    df = s.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("status"), "o_orderpriority")
    return js.row_to_object(df)


@query
def rows_to_json_array(s):
    """The hundred largest orders as one document and back to rows."""
    df = s.orders.select("o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("o_orderstatus"), "o_totalprice")
    doc = js.rows_to_json(df, ["o_orderkey", "o_custkey", "o_orderstatus"], 100, [F.col("o_totalprice").desc(), F.col("o_orderkey").desc()])
    return js.json_to_rows(doc, "document", "key1", {"o_orderkey": "number", "o_custkey": "number", "o_orderstatus": "string"})


@query
def json_relational_join(s):
    """Documents joined with customers on a cast path."""
    joined = js.json_key_join(_order_documents(s), "src", "order.cust", s.customer, "c_custkey")
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum(js.json_get("src", "order.id", "number")).alias("ids"))


@query
def array_building(s):
    """Arrays from single values, with values added at their end and lists joined."""
    df = s.orders.select("o_orderkey", js.to_array("o_orderstatus").alias("a"), F.split("o_orderpriority", "-").alias("b"))
    built = df.select("o_orderkey", js.array_with("a", "o_orderkey").alias("a"), js.array_with(F.concat("a", "b"), F.lit("end")).alias("b"))
    return built.select("o_orderkey", F.concat_ws("|", "a").alias("status_key"), F.concat_ws("|", "b").alias("parts"), F.size("b").cast("bigint").alias("n_parts"))


@query
def prediction_columns(s):
    """A prediction object per labelled document, read into columns."""
    obj = F.to_json(F.struct(F.col("quality").alias("class"), F.struct((F.col("toxic") / 4).alias("False"), (1 - F.col("toxic") / 4).alias("True")).alias("probability")))
    df = s.labels.select("doc_id", js.parse(obj).alias("prediction"))
    return js.struct_to_columns(df, "prediction", {"class": ("class", "number"), "false_probability": ("probability.False", "double"), "true_probability": ("probability.True", "double")})


# ---- change data --------------------------------------------------------------------

CHANGE_FIELDS = {"client": ("client", "string"), "ticker": ("ticker", "string"), "position": ("LongOrShort", "string"), "price": ("Price", "decimal(18,3)"), "quantity": ("Quantity", "decimal(38,3)")}


def _change_log(s):
    """Events as change records: the user is the key, the event time the commit time."""
    action = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    image = F.struct(F.concat(F.lit("c"), F.col("user_id") % 7).alias("client"), F.concat(F.lit("T"), F.col("user_id") % 30).alias("ticker"),
                     F.when(F.col("user_id") % 2 == 0, "LONG").otherwise("SHORT").alias("LongOrShort"), F.col("value").cast("decimal(18,3)").alias("Price"),
                     F.get_json_object("props", "$.k").cast("bigint").alias("Quantity"))
    tx = F.struct(F.lit("PROD").alias("schema"), F.when(F.col("event_type") == "view", "AUDIT").otherwise("LIMIT_ORDERS").alias("table"), action.alias("action"), F.col("user_id").cast("string").alias("primaryKey_tokenized"),
                  F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 1000").alias("committed_at"), F.lit("app").alias("dbuser"), F.when(action == "DELETE", image).alias("record_before"), F.when(action != "DELETE", image).alias("record_after"))
    return s.events.select(js.parse(F.to_json(F.struct(tx.alias("transaction")))).alias("record_content"))


_landed: dict[tuple[str, str, str], str] = {}


def _landing(s):
    """The landing table the feed arrives in, written once per session and state of the source's files."""
    place = (s.spark.sparkContext.applicationId, s.folder, files.state_of(s.spark, f"{s.folder}/events.parquet"))
    if place not in _landed:
        path = scratch(s.spark, "landing")
        _change_log(s).write.parquet(path)
        _landed[place] = path
    return s.spark.read.parquet(_landed[place])


def _order_changes(s):
    return cd.only_source(cd.change_columns(_landing(s), fields=CHANGE_FIELDS), "PROD", "LIMIT_ORDERS")


@query
def cdc_sources(s):
    """Counts per source table of the feed."""
    return cd.landing_counts(cd.change_columns(_landing(s)), "source_schema", "source_table", "action")


def _shown_state(df):
    return df.select(F.col("key"), cd.commit_time("committed_at").alias("last_updated"), "client", "ticker", "position", "price", "quantity")


@query
def cdc_current_state(s):
    return _shown_state(cd.current_state(_order_changes(s), "key", "committed_at"))


def _shown_history(df):
    return df.select("key", "action", F.coalesce("client", "before_client").alias("client"), F.coalesce("ticker", "before_ticker").alias("ticker"), F.coalesce("position", "before_position").alias("position"),
                     "price", "quantity", "is_latest", "version", cd.commit_time("valid_from").alias("valid_from"), cd.commit_time("valid_to").alias("valid_to"))


HOUR_MS = 3_600_000


@query
def cdc_scd2(s):
    return _shown_history(cd.scd2_history(_order_changes(s), "key", "committed_at", "action", 24 * HOUR_MS))


@query
def cdc_summary(s):
    current = cd.current_state(_order_changes(s), "key", "committed_at")
    return cd.position_summary(current, ["ticker", "position"])


#: Files that a batch of the streaming queries takes; more than one, so the number of batches stays small for many files.
MORE_FILES = 64


def _arrivals(s, name, lots=2):
    """The change log as files that arrive out of commit order, for the streaming queries."""
    path = scratch(s.spark, name)
    log = _order_changes(s)
    for lot in range(lots):
        log.where(F.pmod(F.xxhash64("key", "committed_at"), F.lit(lots)) == lot).write.mode("append").parquet(path)
    return path, log.schema


@query
def stream_current_state(s):
    """The current state kept by a stream, file by file, including late changes, with a restart in between."""
    path, schema = _arrivals(s, "changes")
    root = scratch(s.spark, "state")
    keep = lambda: cd.run_available(cd.stream_current_state(cd.read_changes(s.spark, path, schema, maxFilesPerTrigger=MORE_FILES), f"{root}/rows", f"{root}/checkpoint", "key", "committed_at"))
    keep()
    late = s.spark.read.schema(schema).parquet(path).where("action = 'INSERT'").withColumn("committed_at", F.col("committed_at") - 10**12)
    late.write.mode("append").parquet(path)  # older than all: without effect
    keep()
    return _shown_state(cd.kept_state(s.spark, f"{root}/rows", schema, "key").where("action <> 'DELETE'"))


@query
def stream_scd2(s):
    """The type-2 history kept by a stream that only appends."""
    path, schema = _arrivals(s, "changes")
    root = scratch(s.spark, "history")
    cd.run_available(cd.stream_scd2(cd.read_changes(s.spark, path, schema, maxFilesPerTrigger=MORE_FILES), f"{root}/log", f"{root}/checkpoint"))
    return _shown_history(cd.kept_history(s.spark, f"{root}/log", schema, "key", "committed_at", "action", 24 * HOUR_MS))


@query
def scd2_apply(s):
    """A type-1 table and its history after one set of changes."""
    current = s.customer.select("c_custkey", "c_name", "c_mktsegment", F.lit("2024-01-01").cast("date").alias("record_start_time"))
    history = union_all(current.withColumn("record_end_time", F.lit(None).cast("date")),
                        current.where("c_mktsegment = 'BUILDING'").withColumn("record_start_time", F.lit("2023-01-01").cast("date")).withColumn("record_end_time", F.lit("2024-01-01").cast("date")))
    moved = s.customer.where("c_acctbal < 0 or c_acctbal > 9000").select("c_custkey", F.lit("REVIEW").alias("c_mktsegment"))
    new_history, new_current = cd.scd2_apply(history, current, moved, "c_custkey", "2024-06-01")
    return new_history.unionByName(new_current.withColumn("record_end_time", F.lit("9999-12-31").cast("date"))) \
        .groupBy("c_mktsegment", "record_start_time", "record_end_time").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"))


@query
def incremental_two_stage(s):
    """Weather documents through both stages, arriving in two lots."""
    root = scratch(s.spark, "weather")
    doc = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), F.struct(F.concat(F.lit("N"), F.col("user_id") % 25).alias("country"), F.concat(F.lit("city"), F.col("user_id")).alias("name"), F.col("user_id").alias("id")).alias("city"),
                   F.struct((F.col("value") + 250).alias("temp"), (F.col("value") + 240).alias("temp_min"), (F.col("value") + 260).alias("temp_max")).alias("main"), F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"),
                   F.struct((F.col("user_id") % 360).alias("deg"), F.lit(1.5).alias("speed")).alias("wind"))
    raw = s.events.select("ts", F.to_json(doc).alias("value"))
    for lot in ("ts < timestamp_ntz'2024-01-16 00:00:00'", "ts >= timestamp_ntz'2024-01-16 00:00:00'"):
        raw.where(lot).select("value").write.mode("append").text(f"{root}/raw", compression="gzip")
        cd.weather_pipeline(s.spark, f"{root}/raw", f"{root}/stage", f"{root}/final", f"{root}/checkpoints")
    final = s.spark.read.parquet(f"{root}/final")
    return final.groupBy("country", "conditions").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("temp_cel").cast("decimal(12,4)")), 2).alias("temp"), F.round(F.max("temp_max_cel"), 4).alias("hottest"),
                                                      F.min(F.substring(F.col("date").cast("string"), 1, 19)).alias("first_local"), F.sum("wind_dir").alias("wind_dir"))


# ---- files ---------------------------------------------------------------------------

@query
def csv_round_trip_counts(s):
    return pd_.round_trip(s.customer, scratch(s.spark, "csv"), "csv")


@query
def json_round_trip_counts(s):
    return pd_.round_trip(s.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), scratch(s.spark, "json"), "json")


@query
def csv_round_trip_values(s):
    """Values survive quoting: quotes, commas, line breaks, outer blanks, empty text and NULL."""
    path = scratch(s.spark, "csv")
    k = F.col("s_suppkey") % 4
    note = F.when(k == 0, F.concat(F.lit('say "'), "s_name", F.lit('",\ntwice'))).when(k == 1, F.concat(F.lit("  "), "s_name", F.lit(" \t"))).when(k == 2, "")
    df = s.supplier.select("s_suppkey", note.alias("note"), "s_acctbal")
    files.unload_csv(df, path, bytes_per_file=64_000)
    return files.read_csv(s.spark, path, df.schema, header=True, multi_line=True, null_tokens=("\\N",))


_LOAD = "o_orderkey bigint, o_totalprice double, note string"


def _written_orders(s, path, status, bad):
    """Orders of a status as CSV: padded and missing numbers, quotes, commas and blanks in a text, and, if wanted, values and rows that do not load."""
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    wrong = (key % 10 == 3) & F.lit(bad)
    rows = s.orders.where(f"o_orderstatus = '{status}'").select(
        F.when(wrong, F.concat(F.lit("no "), text)).otherwise(F.concat(F.lit(" "), text, F.lit(" "))).alias("k"),
        F.when(key % 4 == 0, F.when(key % 8 == 0, "NULL").otherwise("")).otherwise(F.col("o_totalprice").cast("string")).alias("p"),
        F.concat(F.lit('a "q, '), F.col("o_orderstatus"), F.lit('" b ')).alias("note"))
    files.unload_csv(rows, path, header=False, overwrite=False, compression="none")
    if bad:
        s.spark.range(1).select(F.lit("7,8").alias("value")).write.mode("append").text(path)


@query
def copy_into_once(s):
    """Loading again loads each file once, in three modes: padded numbers, quoted text and null tokens arrive whole, and rows that do not load as the mode says."""
    counts = []
    for mode in ("stop", "skip", "report"):
        root = scratch(s.spark, "load")
        for step, status in enumerate(("F", None, "O")):
            if status:
                _written_orders(s, f"{root}/in", status, mode != "stop")
            cd.copy_into(s.spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", _LOAD, on_error=mode, null_tokens=("NULL", ""))
            rows = cd.loaded(s.spark, f"{root}/out")
            counted = rows.groupBy("note").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.count("o_totalprice").alias("prices"))
            if mode == "report":
                bad = F.regexp_replace(F.regexp_replace("reason", "[0-9]+", "9"), "(?s)^not.*", "fields")
                counted = counted.unionByName(cd.rejects(s.spark, f"{root}/out").groupBy(bad.alias("note")).agg(F.count("file").alias("n")), allowMissingColumns=True)
            counts.append(files.save(counted.withColumns({"mode": F.lit(mode), "load": F.lit(step + 1)}), f"{root}/count-{step}"))
    return union_all(*counts)


@query
def ingest_pipe(s):
    """A continuous load that stamps each row with its load time and reports the rows that do not load."""
    root = scratch(s.spark, "pipe")
    _written_orders(s, f"{root}/in", "P", True)
    cd.run_available(cd.ingest_stream(s.spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", _LOAD, lag=None, zone="Europe/Paris", null_tokens=("NULL", "")))
    good = cd.loaded(s.spark, f"{root}/out").groupBy("note").agg(F.count("o_orderkey").alias("n"), F.count("o_totalprice").alias("prices"), F.count("insert_ts").alias("stamped"))
    return good.unionByName(cd.rejects(s.spark, f"{root}/out").groupBy(F.lit("rejected").alias("note")).agg(F.count("reason").alias("n")), allowMissingColumns=True)


@query
def json_pipe(s):
    """JSON lines loaded into one column; lines that are none are reported."""
    root = scratch(s.spark, "pipe")
    line = F.to_json(F.struct("o_orderkey", "o_orderpriority"))
    s.orders.select(F.when(F.col("o_orderkey") % 7 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(f"{root}/in")
    cd.copy_into(s.spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", "v variant", kind="json", on_error="report")
    good = cd.loaded(s.spark, f"{root}/out").groupBy(js.json_get("v", "o_orderpriority", "string").alias("priority")).agg(F.count(F.lit(1)).alias("n"), F.sum(js.json_get("v", "o_orderkey", "bigint")).alias("keys"))
    return good.unionByName(cd.rejects(s.spark, f"{root}/out").groupBy("reason").agg(F.count("row").alias("n")).withColumnRenamed("reason", "priority"), allowMissingColumns=True)


@query
def infer_csv_schema(s):
    path = scratch(s.spark, "infer")
    df = s.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", F.to_date("l_shipdate").alias("l_shipdate"), F.when(F.col("l_linenumber") > 99, 1).alias("nothing"))
    files.unload_csv(df, path)
    return files.infer_csv_schema(files.read_csv(s.spark, path, header=True))


@query
def inferred_table_text(s):
    path = scratch(s.spark, "infer")
    files.unload_csv(s.supplier, path)
    return files.create_table_text(files.infer_csv_schema(files.read_csv(s.spark, path, header=True)), "SUPPLIER")


@query
def positional_load(s):
    """Columns by position from files of a path pattern, cast and named."""
    root = scratch(s.spark, "positional")
    s.part.where("p_size <= 25").write.csv(f"{root}/small")
    s.part.where("p_size > 25").write.csv(f"{root}/large")
    raw = files.read_csv(s.spark, [f"{root}/small", f"{root}/large"], pattern=".*/small/.*")
    df = files.positional(raw, ["id", "name", "brand", "kind", "size", "price"], ["bigint", "string", "string", "string", "int", "decimal(10,2)"])
    return df.groupBy("size").agg(F.count("id").alias("n"), F.sum("price").alias("price"))


@query
def null_tokens(s):
    """Several null tokens in text and number columns of a CSV file."""
    path = scratch(s.spark, "nulls")
    k = F.col("c_custkey")
    df = s.customer.select(k.alias("id"), F.when(k % 5 == 0, "NULL").when(k % 5 == 1, "null").when(k % 5 == 2, "").otherwise(F.col("c_acctbal").cast("string")).alias("balance"))
    files.unload_csv(df, path)
    out = files.read_csv(s.spark, path, "id bigint, balance double", header=True, null_tokens=("NULL", "null", ""))
    return out.groupBy((F.col("id") % 5).alias("rest")).agg(F.count(F.lit(1)).alias("n"), F.count("balance").alias("known"))


@query
def gen_rows(s):
    """As many generated rows as there are orders, numbered without gaps."""
    n = s.orders.count()
    return files.gen_rows(s.spark, n).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("sum_n"), F.min(F.length("r")).alias("shortest"), F.max(F.length("r")).alias("longest"))


@query
def list_files(s):
    path = scratch(s.spark, "listed")
    s.orders.repartition(3).write.csv(path)
    return files.list_files(s.spark, path).where("path like '%.csv'").agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") > 0).alias("filled"))


@query
def peek_rows(s):
    path = scratch(s.spark, "peek")
    s.orders.select("o_orderkey", "o_orderstatus").write.csv(path)
    return files.peek(s.spark, path, 10).agg(F.count("_c0").alias("n"), F.count("_c1").alias("second"))


@query
def json_variant_scan(s):
    """One semi-structured value per line of compressed JSON files."""
    path = scratch(s.spark, "variant")
    files.unload_json(s.customer, path)
    df = files.read_json_variant(s.spark, path)
    return df.groupBy(js.json_get("v", "c_mktsegment", "string").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.sum(js.json_get("v", "c_custkey", "number")).alias("keys"))


@query
def merge_upsert(s):
    """Orders of one status replaced, new keys added."""
    target = s.orders.where("o_orderkey % 10 <> 3").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = s.orders.where("o_orderstatus = 'P'").select("o_orderkey", F.lit("M").alias("o_orderstatus"), (F.col("o_totalprice") * 0).alias("o_totalprice"))
    return files.merge_rows(target, changed, ["o_orderkey"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(m.money("o_totalprice")).alias("total"))


@query
def delete_update(s):
    df = files.delete_where(s.customer.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"), "c_acctbal"), "seg = 'MACHINERY'")
    df = files.update_where(df, "c_acctbal < 0", {"seg": F.lit("DEBT")})
    return df.groupBy("seg").agg(F.count(F.lit(1)).alias("n"), F.sum(m.money("c_acctbal")).alias("balance"))


@query
def snapshot_feed(s):
    """What a merge, a deletion and an update did to a table, as a feed that a reader takes up once and that leads from the old version to the new one."""
    root = scratch(s.spark, "versions")
    old = s.orders.where("o_orderkey % 10 <> 3").select("o_orderkey", "o_orderstatus", m.money("o_totalprice").alias("price"))
    sn.write_version(old, f"{root}/table", 0)
    feeds = []
    take = lambda: sn.consume(s.spark, f"{root}/table", f"{root}/offset", ["o_orderkey"], lambda feed, version: feeds.append(files.save(feed, f"{root}/feed-{version}")))
    take()
    new = files.merge_rows(old, s.orders.where("o_orderkey % 20 >= 13").select("o_orderkey", F.lit("M").alias("o_orderstatus"), m.money("o_totalprice").alias("price")), ["o_orderkey"])
    sn.write_version(new, f"{root}/table", 1)
    new = files.update_where(files.delete_where(new, "o_orderkey % 7 = 0"), "o_orderkey % 11 = 0", {"price": "price + 1"})
    sn.write_version(new, f"{root}/table", 2)
    take(), take()
    feed, = feeds
    again, now = (df.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("price").alias("price"), F.lit(kind).alias("action")) for df, kind in (
        (sn.replayed(old, feed), "replayed"), (sn.read_version(s.spark, f"{root}/table", 2), "read")))
    moves = feed.groupBy("action", "is_update").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("price").alias("price"))
    return moves.unionByName(again, allowMissingColumns=True).unionByName(now, allowMissingColumns=True)


@query
def summary_maintained(s):
    """A summary kept from lots of new and of deleted orders, with the newest orders put on top when it is read."""
    path = scratch(s.spark, "summary")
    orders = s.orders.select("o_custkey", "o_orderkey", "o_orderstatus", m.money("o_totalprice").alias("price"), F.to_date("o_orderdate").alias("day"))
    what = sm.Measures(("o_custkey",), sums=("price",), lows=("day", "price"), highs=("price",), distinct=("o_orderstatus", "day"))
    sm.fold(orders.where("o_orderkey % 5 < 3"), what, path, 0)
    sm.fold(orders.where("o_orderkey % 5 = 3"), what, path, 1)
    base = orders.where("o_orderkey % 5 <= 3")
    gone = "price > 200000 or o_custkey % 9 = 0"
    sm.fold(base.where(gone).withColumn("action", F.lit("DELETE")), what, path, 2, base.where(f"not ({gone})"))
    return sm.current(s.spark, what, path, orders.where("o_orderkey % 5 = 4"))


@query
def ctas_append(s):
    """Empty copy by schema, then append twice."""
    path = scratch(s.spark, "ctas")
    files.save(files.empty_like(s.nation), path)
    files.save(s.nation, path, append=True)
    return files.save(s.nation.where("n_regionkey = 1"), path, append=True).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


# ---- quality -------------------------------------------------------------------------------

@query
def unique_violations(s):
    return dq.unique_violations(s.lineitem, ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(s):
    kept = s.orders.where("o_orderstatus <> 'P'")
    return dq.fk_orphans(s.lineitem, kept, "l_orderkey", "o_orderkey").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query
def fk_referenced(s):
    return dq.fk_referenced(s.part, s.lineitem, "p_partkey", "l_partkey").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@query
def quote_repair(s):
    """CSV lines with stray quotes inside a quoted text, one per part."""
    q = F.lit('"')
    raw = F.concat(q, F.lit("A"), F.lit('","'), F.col("p_partkey").cast("string"), F.lit('","'), F.substring("p_name", 1, 3), q, F.substring("p_name", 4, 30), F.lit('",other""thing,"'), "p_brand", q, F.lit('TACK","","",,"'), "p_type", q)
    return dq.repair_quotes(s.part.select(raw.alias("raw")), "raw", ["id", "part_id", "text1", "text2", "other_id", "text3", "text4", "text5"])


@query
def typed_load_rejects(s):
    """Rows that load and rows that do not parse."""
    text = s.customer.select(F.when(F.col("c_custkey") % 10 == 3, F.concat(F.col("c_custkey"), F.lit(".5"))).otherwise(F.concat(F.lit(" "), F.col("c_custkey"))).alias("id"),
                             F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_acctbal").cast("string")).alias("balance"))
    good, bad = files.typed_load(text, "id bigint, balance double")
    return good.agg(F.lit("loaded").alias("side"), F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.count("balance").alias("balances")) \
        .unionByName(bad.agg(F.lit("rejected").alias("side"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("ids"), F.count("balance").alias("balances")))


@query
def null_defaults(s):
    df = s.orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("o_orderstatus"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))
    filled = dq.apply_defaults(df, {"o_orderstatus": "INQUEUE"}).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select(F.col("o_orderstatus").alias("what"), "n")
    missing = dq.not_null_violations(df, ["o_orderstatus", "o_orderpriority"]).groupBy(F.concat(F.lit("missing "), "missing").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return filled.unionByName(missing)


# ---- governance ------------------------------------------------------------------------------

def _employees(s):
    """Suppliers as staff: a binary tree whose root reports to itself."""
    k = F.col("s_suppkey")
    dept = F.element_at(F.array(*[F.lit(d) for d in ("ENGINEERING", "MARKETING", "HR", "FINANCE")]), (k % 4 + 1).cast("int"))
    return s.supplier.select(F.concat(F.lit("E"), k).alias("employee_id"), F.concat(F.lit("E"), F.floor(k / 2)).alias("reports_to"), (k * 1000 + 50000).alias("salary"), dept.alias("department"),
                             F.concat(F.lpad((k % 1000).cast("string"), 3, "5"), F.lit("-44-"), F.lpad((k * 7 % 10000).cast("string"), 4, "0")).alias("ssn"))


@query
def mask_partial(s):
    e = _employees(s)
    seen = union_all(*[e.select(F.lit(role).alias("role"), "employee_id", gv.mask("salary", "null", role).alias("salary"), gv.mask("ssn", "last4", role).alias("ssn"), gv.mask("department", "constant", role).alias("department"))
                       for role in ("ACCOUNTADMIN", gv.ADMIN)])
    return seen


_CALLERS = (("RL_EMPLOYEE", "E5"), ("RL_MANAGER", "E3"), ("RL_HR_REP", "E6"), (gv.ADMIN, "X"), ("PUBLIC", "E1"))


@query
def mask_role_matrix(s):
    e = _employees(s)
    return union_all(*[gv.employee_view(e, role, user).groupBy(F.lit(role).alias("role"), "department").agg(F.count(F.lit(1)).alias("n"), F.sum("salary").alias("salary"), F.count_if(F.col("ssn").startswith("*")).alias("masked")) for role, user in _CALLERS])


@query
def row_filter_by_mask(s):
    e = _employees(s)
    return union_all(*[gv.visible_rows(e, role, user).select(F.lit(role).alias("role"), "employee_id", "salary") for role, user in _CALLERS])


@query
def manager_closure(s):
    return gv.reports_closure(_employees(s))


@query
def rollup_only_role(s):
    e = _employees(s)
    return gv.department_rollup(e, "RL_FINANCE").unionByName(gv.department_rollup(e, "RL_EMPLOYEE"))


@query
def tenant_view(s):
    mapping = s.customer.select("c_custkey", F.concat(F.lit("org-"), F.col("c_nationkey")).alias("account")).union(s.customer.where("c_nationkey = 7").select("c_custkey", F.lit("org-7")))
    seen = gv.tenant_view(s.orders, mapping, "o_custkey", "org-7", mapping_key="c_custkey")
    return seen.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum(m.money("o_totalprice")).alias("total"))


# A key for the self-contained check only; real keys come from configuration.
_DEMO_KEY = "0123456789abcdef01234567"


@query
def aes_decrypt_view(s):
    cipher = F.base64(F.aes_encrypt(F.col("c_name"), F.lit(_DEMO_KEY), F.lit("ECB"), F.lit("PKCS")))
    df = s.customer.select("c_custkey", cipher.alias("secret"))
    seen = [gv.decrypt_view(df, "secret", _DEMO_KEY, role).select(F.lit(role).alias("role"), "c_custkey", "decrypted") for role in ("PII_ALLOWED", "PUBLIC")]
    broken = df.select(F.lit("BROKEN").alias("role"), "c_custkey", m.decrypt_text(F.concat(F.lit("AAAA"), "secret"), _DEMO_KEY).alias("decrypted"))
    return union_all(*seen, broken)


# ---- analytics and classification ----------------------------------------------------------------

@query
def cost_allocation(s):
    """Hourly metering of twenty warehouses split over the queries that started in each hour."""
    wh = F.col("user_id") % 20
    hour = F.date_trunc("hour", "ts")
    metering = s.events.groupBy(wh.alias("entity_id"), hour.alias("start_time")).agg(F.count_if(F.col("event_type") == "purchase").alias("credits_used")) \
        .select("entity_id", F.concat(F.lit("WH"), "entity_id").alias("name"), "start_time", (F.col("start_time") + F.expr("interval 1 hour")).alias("end_time"), "credits_used")
    queries = s.events.select(F.col("event_id").alias("query_id"), F.concat(F.lit("u"), F.col("user_id") % 50).alias("user_name"), wh.alias("warehouse_id"), (F.col("event_id") % 97 + 1).alias("execution_time"),
                              F.col("ts").alias("start_time"), F.when(F.col("event_type") != "error", "X-Small").alias("warehouse_size"))
    return an.allocate_credits(metering, queries, "2024-02-15")


@query
def month_offset_pivot(s):
    """Order value of the six months before a date, one column each."""
    as_of = "2001-06-15"
    back = F.months_between(F.trunc(F.lit(as_of).cast("date"), "month"), F.trunc(F.to_date("o_orderdate"), "month")).cast("int")
    df = s.orders.withColumn("back", back).where("back between 1 and 6")
    return df.groupBy("o_orderpriority").agg(*[F.sum(F.when(F.col("back") == i, m.money("o_totalprice"))).alias(f"prev_month{i}") for i in range(1, 7)])


@query
def privacy_erasure(s):
    """What remains after a fifth of all customers asked to be erased."""
    o = s.orders
    paid = F.when(F.col("o_custkey") % 3 == 0, F.col("o_totalprice") - 10).otherwise(F.col("o_totalprice"))
    purchases = o.where("o_custkey % 2 = 0 or year(o_orderdate) < 2000").select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("price"), paid.alias("paid"), F.to_date("o_orderdate").alias("purchase_date"))
    reviews = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("review"))
    left_reviews, left_purchases = an.erase_customers(s.customer.where("c_custkey % 5 < 2").select("c_custkey"), reviews, purchases, "2001-06-15")
    return left_reviews.agg(F.lit("reviews").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("customer_id").alias("ids")) \
        .unionByName(left_purchases.agg(F.lit("purchases").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("customer_id").alias("ids")))


def _anomalies(s):
    return an.anomalies(an.daily_totals(s.events, "ts", "value", "event_type"), "2024-01-21", z=1.5)


@query
def anomaly_daily(s):
    a = _anomalies(s)
    return a.select("series", "ts", F.round("y", 4).alias("y"), *[F.round(c, 4).alias(c) for c in ("forecast", "lower_bound", "upper_bound")], "is_anomaly")


@query
def alert_exists(s):
    fired = an.alerts(_anomalies(s), ["2024-01-21", "2024-12-31"])
    return fired.select("fire", F.when(F.month("since") == 1, "start").otherwise("end").alias("since"))


@query
def hash_split(s):
    """Every row in exactly one group, the same in both reads, near the asked share."""
    one, two = an.hash_split(s.orders, ["o_orderkey"]), an.hash_split(s.orders.repartition(5), ["o_orderkey"])
    both = one.select("o_orderkey", "split_group").join(two.select(F.col("o_orderkey").alias("k"), F.col("split_group").alias("again")), F.col("o_orderkey") == F.col("k"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split_group") == F.col("again")).alias("stable"), (ratio(F.count_if(F.col("split_group") == "training"), F.count(F.lit(1))).between(0.93, 0.97)).alias("near_95"))


@query
def class_balance(s):
    return an.class_balance(s.labels, "quality")


def _scored(s):
    """Labelled documents with a score in [0, 1] from their length."""
    return s.labels.join(s.documents.select(F.col("doc_id").alias("d"), "n_chars"), F.col("doc_id") == F.col("d")) \
        .select("doc_id", "quality", (F.col("n_chars") / (F.col("n_chars") + 1000)).alias("score"), (F.col("n_chars") > 500).cast("int").alias("predicted"))


@query
def confusion_matrix(s):
    return an.confusion(_scored(s), "quality", "predicted")


@query
def evaluation_metrics(s):
    return an.metrics(_scored(s), "quality", "predicted")


@query
def threshold_curve(s):
    return an.threshold_curve(_scored(s), "quality", "score")


@query
def auc(s):
    return an.auc(_scored(s), "quality", "score")


@query
def auc_skewed(s):
    """Scores that nearly all lie in one hundred-thousandth of their range."""
    skewed = _scored(s).withColumn("score", F.when(F.col("doc_id") % 50 == 0, 1.0).otherwise(F.round(F.col("score"), 3) / 100000))
    return an.auc(skewed, "quality", "score")


def _training(s):
    """Order lines with a target that the discount and the kind of part explain in part."""
    df = star_join(s.lineitem, (s.part.select("p_partkey", "p_type"), "l_partkey", "p_partkey"))
    flag = F.when((F.col("l_discount") > 0.05) | ((F.col("p_type") == "PROMO") & (F.col("l_quantity") > 25)), "True").otherwise("False")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "p_type", flag.alias("subscribed"))


@query
def classifier_predictions(s):
    """Train on 95 %, predict the rest: facts that must hold of the result."""
    split = an.hash_split(_training(s), ["l_orderkey", "l_linenumber"])
    held = split.where("split_group = 'inference'")
    model = an.train_classifier(split.where("split_group = 'training'"), "subscribed", ["p_type"], ["l_quantity", "l_discount", "l_tax"])
    scored = an.predict(model, held)
    known = F.col("predicted").isin("True", "False")
    sums = F.abs(F.col("probability_True") + F.col("probability_False") - 1) < 1e-9
    right = F.avg((F.col("predicted") == F.col("subscribed")).cast("double"))
    facts = scored.agg(F.count(F.lit(1)).alias("n"), F.every(known).alias("each_has_a_class"), F.every(sums).alias("sums_to_one"), (right > 0.8).alias("accurate"))
    return held.agg(F.count(F.lit(1)).alias("n_held")).crossJoin(facts).select((F.col("n") == F.col("n_held")).alias("all_scored"), "each_has_a_class", "sums_to_one", "accurate")


@query
def feature_importance(s):
    df = _training(s)
    found = an.importance(an.train_classifier(df, "subscribed", ["p_type"], ["l_quantity", "l_discount", "l_tax"]), df)
    return found.agg(F.max_by("feature", "score").alias("first"), F.count("feature").alias("n_features"), F.every(F.col("score") >= 0).alias("weights"))


@query
def text_blob_rows(s):
    """Lines of text blobs as rows with an id and a name, the blank after the comma kept."""
    blobs = s.customer.groupBy("c_nationkey", (F.floor(F.col("c_custkey") / 50)).alias("lot")).agg(F.concat_ws("\n", F.sort_array(F.collect_list(F.concat("c_custkey", F.lit(", "), "c_name")))).alias("blob"))
    out = an.explode_lines(blobs, "blob", ",", ["id", "name"])
    return out.select("c_nationkey", F.col("id").cast("bigint").alias("id"), "name")


@query
def row_count(s):
    return s.spark.sql("select count(*) as n_rows from {orders}", orders=s.orders)


# ---- layout -------------------------------------------------------------------------------------------

@query
def summary_answer(s):
    """Point query on a stored summary of orders per customer."""
    summary = pd_.build_summary(s.orders, ["o_custkey"], [F.sum(m.money("o_totalprice")).alias("sum_total_price"), F.count(F.lit(1)).alias("num_orders")], scratch(s.spark, "summary"))
    return pd_.answer(summary, "o_custkey between 55 and 60")


@query
def denorm_lookup(s):
    """Lookups on a wide table that is clustered on one column and filtered on others."""
    wide = pd_.denormalise(s.lineitem, (s.orders, "l_orderkey", "o_orderkey"), (s.customer, "o_custkey", "c_custkey"))
    table = pd_.build_lookup(wide, ["o_orderdate"], ["c_custkey", "l_partkey"], scratch(s.spark, "lookup"))
    return pd_.lookup(table, c_custkey=77).select("l_orderkey", "l_linenumber", "l_partkey", "c_name")


@query
def sorted_load_counts(s):
    path = scratch(s.spark, "sorted")
    r.clustered_write(s.lineitem, ["l_partkey", "l_orderkey"], path)
    return r.reconcile({"source": s.lineitem, "sorted": s.spark.read.parquet(path), "part 7": s.spark.read.parquet(path).where("l_partkey = 7")})

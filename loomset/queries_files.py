"""Queries that act on files of their own and look at them again, and queries on JSON texts."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import jsontext, values
from .functions.tags import parse_list
from .operators import audit, delta, jsonops, reconcile
from .plans.filters import ColumnBinding, FilterSpec, TagRule
from .queries import read
from .queries_io import QUERIES, SQL, _dealt, _part, _store, packed_tars, query
from .sinks import actions, compaction, outputs, snapshots
from .sources import files, state, tables, verify
from .streaming import shard_stream

__all__ = ["QUERIES", "SQL"]


def _tree(spark: SparkSession, at: str) -> DataFrame:
    """(folder, name, content) of the visible files."""
    found = files.inventory(spark, at, True).select("path", F.col("shard").alias("folder"), "name")
    return files.texts_of(found).select("folder", "name", F.col("text").alias("content"))


class _Refusing(actions.Store):
    """Pictures of every fifth id can't be renamed, as on a store that loses its connection there."""

    def move(self, uri: str, target: str) -> None:
        stem = uri.rsplit("/", 1)[1].split("_")[0].split(".")[0]
        if uri.endswith(".png") and stem.isdigit() and int(stem) % 5 == 0:
            raise OSError("refused")
        super().move(uri, target)


_LEFT = "(p_partkey % 5 = 0 OR p_partkey % 7 = 0)"
_NAME = f"p_partkey || CASE WHEN {_LEFT} THEN '' ELSE '_x' END"


@query(f"""SELECT printf('shard_%05d', p_partkey // 500) AS folder, {_NAME} || '.png' AS name, p_name AS content FROM part
 UNION ALL SELECT printf('shard_%05d', p_partkey // 500), {_NAME} || '.json', CASE
  WHEN p_partkey % 7 = 0 THEN '["old.png", 1]'
  WHEN p_partkey % 3 = 1 THEN '{{"n": 1.50' || CASE WHEN {_LEFT} THEN '' ELSE ', "file_name": "' || {_NAME} || '.png"' END || '}}'
  ELSE '{{"big": 9007199254740993, "file_name" : "' || CASE WHEN {_LEFT} THEN 'old' ELSE {_NAME} END || '.png", "o": {{"file_name": null, "a": [1, 2.0]}}, "s": "' || p_name || '"}}' END FROM part""")
def rename_pairs_on_files(spark, sf_dir):
    """Pictures and sidecars get a suffix together; a refused rename or a sidecar that is
    no object leaves its pair as it was."""
    at, c = state.scratch(spark, "rename"), F.col("id")
    kind = F.when(c % 7 == 0, '["old.png", 1]').when(c % 3 == 1, '{"n": 1.50}').otherwise(
        F.concat(F.lit('{"big": 9007199254740993, "file_name" : "old.png", "o": {"file_name": null, "a": [1, 2.0]}, "s": '), jsontext.quoted(F.col("name")), F.lit("}"))
    )
    rows = _dealt(spark, sf_dir).select(values.shard_name(c, 500).alias("shard"), "id", F.lit(".png").alias("ext"), F.encode("name", "UTF-8").alias("content"), kind.alias("json"))
    outputs.write_pairs(rows, _store, f"{at}/data").count()
    pictures = files.inventory(spark, f"{at}/data", True).where("ext = '.png'")
    texts = files.json_texts(spark, f"{at}/data").select(F.regexp_replace("path", r"\.json\z", "").alias("base"), "text")
    base = F.concat("dir", F.lit("/"), "stem")
    pairs = pictures.select(base.alias("base"), F.concat("stem", F.lit("_x.png")).alias("new_name"), "path").join(texts, "base")
    plan = pairs.select(
        "base", "path", F.concat("base", F.lit("_x.png")).alias("new"), F.concat("base", F.lit(".json")).alias("json_path"),
        F.concat("base", F.lit("_x.json")).alias("json_new"), jsonops.patch_file_name(F.col("text"), F.col("new_name")).alias("patched"),
    )
    actions.stage(plan.select("base", actions.rename_steps("path", "new", "json_path", "json_new", "patched").alias("steps")), f"{at}/journal", "base")
    actions.commit(spark, f"{at}/journal", _Refusing)
    return _tree(spark, f"{at}/data")


@query("""SELECT printf('shard_%05d', p_partkey // 500) AS folder, p_partkey || e AS name, CASE e WHEN '.png' THEN p_name ELSE '{}' END AS content
 FROM part, (SELECT unnest(['.png', '.json']) AS e) WHERE p_partkey % 4 <> 0""")
def remove_pairs_on_files(spark, sf_dir):
    """A corrupt picture takes its sidecar along. What one journal removes is brought
    back; what another removes is gone for good once purged."""
    at = state.scratch(spark, "remove")
    rows = _dealt(spark, sf_dir).select(values.shard_name(F.col("id"), 500).alias("shard"), "id", F.lit(".png").alias("ext"), F.encode("name", "UTF-8").alias("content"), F.lit("{}").alias("json"))
    outputs.write_pairs(rows, _store, f"{at}/data").count()
    found = files.inventory(spark, f"{at}/data", True)
    for k, journal in ((3, f"{at}/back"), (4, f"{at}/gone")):
        corrupt = found.where(F.col("ext") == ".png").withColumn("class", F.when(F.col("stem") % k == 0, "corrupt").otherwise("valid"))
        plan = audit.removal_plan(audit.with_sidecar_path(corrupt, found)).select("path", actions.removal_steps("path", "json_path").alias("steps"))
        actions.stage(plan, journal, "path")
        actions.commit(spark, journal)
        if k == 3:
            actions.roll_back(spark, journal)
        else:
            actions.purge(spark, journal)
    return _tree(spark, f"{at}/data")


# ------------------------------------------------------------------------ pictures
def _chunk(name: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


@F.pandas_udf(T.BinaryType())
def _drawn(width: pd.Series, height: pd.Series, text: pd.Series) -> pd.Series:
    """A grey PNG whose rows repeat a text."""

    def one(w: int, h: int, t: str) -> bytes:
        row = b"\0" + (t.encode() * w)[:w]
        return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(row * h)) + _chunk(b"IEND", b"")

    return pd.Series([one(*x) for x in zip(width, height, text)])


def _pictures(spark, sf_dir) -> DataFrame:
    """A picture per part, whole or damaged in one of eight ways."""
    k, png = F.col("id") % 9, F.col("png")
    n = F.octet_length(png)
    flipped = lambda at: F.overlay(png, F.unhex(F.lpad(F.hex((F.conv(F.hex(F.substring(png, at, F.lit(1))), 16, 10).cast("int") + 1) % 256), 2, "0")), at)
    cut = lambda size: F.substring(png, F.lit(1), size)
    made = (
        F.when(k == 1, cut(F.lit(6))).when(k == 2, cut(F.lit(20))).when(k == 3, cut(F.lit(31))).when(k == 4, cut(F.lit(45)))
        .when(k == 5, flipped(n - 12)).when(k == 6, cut(n - 12)).when(k == 7, F.encode("name", "UTF-8")).when(k == 8, flipped(F.lit(31))).otherwise(png)
    )
    rows = _dealt(spark, sf_dir).withColumns({"w": F.col("size") + 60, "h": F.lit(80)})
    return rows.withColumn("png", _drawn("w", "h", "name")).select(values.shard_name(F.col("id"), 500).alias("shard"), "id", F.lit(".png").alias("ext"), made.alias("content"), F.lit("{}").alias("json"))


@query("""SELECT p_partkey AS id, CASE WHEN k IN (1, 3, 7, 8) THEN 'not_an_image' WHEN k = 2 THEN 'invalid_image_OSError' WHEN p_size + 60 < 64 THEN 'dimensions_' || p_size + 60 || 'x80'
 WHEN k IN (4, 6) THEN 'invalid_image_OSError' WHEN k = 5 THEN 'invalid_image_SyntaxError' END AS reason, k = 4 AS unreadable FROM (SELECT *, p_partkey % 9 AS k FROM part)""")
def image_verification(spark, sf_dir):
    """Files cut or changed at each kind of place, opened on the executors and read whole."""
    at = state.scratch(spark, "pictures")
    outputs.write_pairs(_pictures(spark, sf_dir), _store, at).count()
    found = verify.verified_files(files.inventory(spark, at, True).where("ext = '.png'"))
    reason = audit.invalid_reason(F.col("size"), F.col("width"), F.col("height"), F.col("error"), min_size=1, damage=F.col("damage"))
    return found.select(F.col("stem").cast("bigint").alias("id"), reason.alias("reason"), F.col("unreadable").isNotNull().alias("unreadable"))


@query("""SELECT CASE WHEN p_partkey % 11 = 0 THEN 'gone' WHEN p_partkey % 9 IN (1, 2, 3, 4, 7, 8) OR p_size <> 20 THEN 'odd' ELSE 'kept' END AS place, count(*) AS pictures,
 sum(p_partkey) AS ids FROM part WHERE p_partkey % 11 <> 0 GROUP BY ALL""")
def sort_pictures_on_files(spark, sf_dir):
    """Unreadable pictures and ones that aren't square go elsewhere with their sidecars,
    names that are there already are deleted."""
    at = state.scratch(spark, "sorted")
    outputs.write_pairs(_pictures(spark, sf_dir).withColumn("shard", F.lit("in")), _store, at, shared=True).count()
    found = files.inventory(spark, f"{at}/in")
    seen = verify.verified_files(found.where("ext = '.png'")).withColumn("error", F.coalesce("error", "unreadable"))
    there = _part(spark, sf_dir).where("id % 11 = 0").select(F.concat(F.col("id").cast("string"), F.lit(".png")).alias("name"))
    act = audit.file_action(seen.withColumnRenamed("width", "w").withColumnRenamed("height", "h"), there)
    plan = audit.with_sidecar_path(act, found).where("action <> 'none'")
    odd = lambda c: F.concat(F.lit(f"{at}/odd/"), F.substring_index(c, "/", -1))
    plan = plan.withColumns({"to": odd("path"), "json_to": odd("json_path")})
    steps = F.when(F.col("action") == "move", actions.move_steps("path", "to", "json_path", "json_to")).otherwise(actions.removal_steps("path", "json_path"))
    actions.stage(plan.select("path", steps.alias("steps")), f"{at}/journal", "path")
    actions.commit(spark, f"{at}/journal")
    left = files.inventory(spark, at, True).where("shard IN ('in', 'odd')").groupBy(F.when(F.col("shard") == "in", "kept").otherwise("odd").alias("place"), F.substring_index("name", ".", 1).cast("bigint").alias("id"))
    return left.agg(F.count("*").alias("n")).where("n = 2").groupBy("place").agg(F.count("*").alias("pictures"), F.sum("id").alias("ids"))


# ---------------------------------------------------------------------------- JSON
@query("""SELECT p_partkey AS id, CASE p_partkey % 4
 WHEN 0 THEN '{"file_name": "' || p_partkey || '.png","score":' || p_size || ',"tags":["x", "' || p_brand || '"],"o":{"k":1.50,"file_name":"in"},"z":null}'
 WHEN 1 THEN '{"score":' || p_size || ', "file_name": "' || p_partkey || '.png"}' WHEN 2 THEN '{"file_name": "' || p_partkey || '.png"}' END AS text FROM part""")
def json_typed_edit(spark, sf_dir):
    """One member of a text is set, numbers, lists and nested objects stay as written; a list is left out."""
    k = F.col("id") % 4
    old = F.concat(F.lit('{"file_name": ["old"],"score":'), "size", F.lit(',"tags":["x", "'), "brand", F.lit('"],"o":{"k":1.50,"file_name":"in"},"z":null}'))
    text = F.when(k == 0, old).when(k == 1, F.concat(F.lit('{"score":'), "size", F.lit("}"))).when(k == 2, "{}").otherwise('["file_name"]')
    return _part(spark, sf_dir).select("id", jsonops.patch_file_name(text, F.concat(F.col("id").cast("string"), F.lit(".png"))).alias("text"))


@query("""SELECT p_partkey AS id, 0 AS item, 'a' AS key, p_size::VARCHAR AS value FROM part WHERE p_partkey % 3 < 2 UNION ALL SELECT p_partkey, 0, 'z', NULL FROM part WHERE p_partkey % 3 < 2
 UNION ALL SELECT p_partkey, 1, 'b', '["' || p_brand || '",1]' FROM part WHERE p_partkey % 3 = 0""")
def json_flatten_mixed_lists(spark, sf_dir):
    """Objects of a list that holds other things too; what follows a first value makes a text malformed."""
    k, one = F.col("id") % 3, F.concat(F.lit('{"a": '), "size", F.lit(', "z": null}'))
    text = F.when(k == 0, F.concat(F.lit('["x", '), one, F.lit(', 3, null, [{"n": 1}], {"b": ["'), "brand", F.lit('", 1]}, "{}"]'))).when(k == 1, one).otherwise(F.concat(one, F.lit(" {}")))
    return jsonops.flatten_objects(_part(spark, sf_dir).select("id", text.alias("text")), "text")


@query("SELECT event_id FROM events WHERE event_type = 'click'")
def json_keyword_at_depth(spark, sf_dir):
    """The keyword as a value 200 levels down, its letters escaped; as a key it doesn't count."""
    nested = F.concat(F.lit('{"click": [' * 200 + '" CL'), F.lit("\\u0049"), F.lit('CK "'), F.lit("]}" * 200))
    text = F.when(F.col("event_type") == "click", nested).otherwise(F.to_json(F.struct(F.col("event_type").alias("click"))))
    return read(spark, sf_dir, "events").where(jsonops.contains_keyword(text, "click")).select("event_id")


@query("""SELECT o_orderkey + 9007199254740993 AS id, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey + 9007199254740993 WHEN 1 THEN o_orderkey ELSE 0 END AS score
 FROM orders WHERE o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND o_orderkey >= 100)""")
def numbers_beyond_doubles(spark, sf_dir):
    """Ids and scores above 2**53 stay exact, as numbers and as text; fractions are cut, other text is zero."""
    key, k = F.col("o_orderkey"), F.col("o_orderkey") % 3
    exact = key + F.lit(9007199254740993)
    score = F.when(k == 0, exact.cast("string")).when(k == 1, F.concat(key.cast("string"), F.lit(".75"))).otherwise("many")
    bound = ColumnBinding("big", None, None, None, None, None, "said", None, None, None, None)
    return FilterSpec(min_score=100).apply_raw(read(spark, sf_dir, "orders").select(exact.alias("big"), score.alias("said")), bound)


# ------------------------------------------------------------- manifests and state
@query("""SELECT 't' || k || '.tar' AS archive, p_partkey AS image_id, CASE WHEN k = 3 THEN 'in/' || p_partkey || '.png' WHEN k IN (6, 7) THEN 'in/' || p_partkey || '.jpg' ELSE p_partkey || '.jpg' END AS inner_path
 FROM (SELECT *, p_partkey % 9 AS k FROM part)""")
def manifest_cascade(spark, sf_dir):
    """Five shapes of manifest; an empty first and a broken second give way to the third, of
    two usable ones the first counts, and archives without any are opened for their headers.
    Those with one hold no tar data at all."""
    at = state.scratch(spark, "cascade")
    rows = _part(spark, sf_dir).select((F.col("id") % 9).cast("int").alias("k"), "id", "name")
    packed_tars(rows.where("k IN (6, 7)"), at)
    i = F.col("id").cast("string")
    name = F.concat(i, F.lit(".jpg"))
    lists = rows.groupBy("k").agg(F.collect_list(name).alias("names"), F.map_from_entries(F.collect_list(F.struct(i, F.concat(F.lit("in/"), i, F.lit(".png"))))).alias("paths"))
    detail = F.map_from_arrays("names", F.transform("names", lambda n: F.struct(F.length(n).alias("size"))))
    names, k = F.to_json("names"), F.col("k")
    wrapped = lambda x: F.concat(F.lit('{"files": '), F.to_json(x), F.lit("}"))
    first = F.when(k == 0, wrapped(detail)).when(k == 1, wrapped("names")).when(k == 2, F.to_json(detail)).when(k == 3, F.to_json("paths")).when(k == 5, "{}").when(k == 6, '{"files": [').when(k.isin(4, 8), names)
    second = F.when(k == 5, '["cut short').when(k == 8, F.to_json(F.transform("names", lambda n: F.concat(F.lit("other/"), n))))
    third = F.when(k == 5, names)
    texts = [(".json", first), ("_manifest.json", second), ("_files.json", third), (".tar", F.when(~k.isin(6, 7), "no tar"))]
    made = lists.select("k", F.explode(F.array(*[F.struct(F.lit(e).alias("end"), t.alias("text")) for e, t in texts])).alias("f")).select("k", "f.*").where("text IS NOT NULL")
    steps = F.array(actions._step("write", F.concat(F.lit(f"{at}/t"), k.cast("string"), F.col("end")), content=F.col("text")))
    actions.stage(made.select(F.concat(k.cast("string"), "end").alias("item"), steps.alias("steps")), f"{at}.journal")
    actions.commit(spark, f"{at}.journal")
    return files.archive_index(spark, at)


@query("SELECT o_orderkey AS id, (row_number() OVER (ORDER BY o_orderkey % 3, o_orderkey DESC) - 1) // 1000 AS shard FROM orders")
def shard_by_arrival(spark, sf_dir):
    """Three files arrive one by one, each in descending order of ids and with some ids of
    the one before; the last batch runs twice."""
    at, key = state.scratch(spark, "arrivals"), F.col("o_orderkey")
    orders = read(spark, sf_dir, "orders").select(key.alias("id"), (-key).alias("arrival"), (key % 3).alias("k"))
    for k in range(3):
        again = orders.where(f"k = {k - 1} AND id % 5 = 0")
        orders.where(f"k = {k}").unionByName(again).select("id", "arrival").coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = spark.readStream.schema("id long, arrival long").option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    shard_stream.assign(stream, f"{at}/table", f"{at}/checkpoint", 1000).awaitTermination()
    last = shard_stream.epochs(spark, f"{at}/table")[-1]
    shard_stream.assign_batch(orders.where("k = 2").select("id", "arrival"), last, f"{at}/table", 1000, "arrival")
    return shard_stream.manifest(spark, f"{at}/table")


@query("""SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'missing' ELSE 'completed' END AS status, CASE WHEN toxic = 1 THEN 'missing' ELSE 'completed' END AS compacted,
 'completed' AS pinned FROM labels""")
def status_snapshots(spark, sf_dir):
    """A reader that took its snapshot before a batch and a compaction goes on reading it;
    a batch that is committed again counts once."""
    lab, log = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), snapshots.status_log(spark, state.scratch(spark, "log"))
    batch = lambda rows, status, n: rows.select("id", F.lit(status).alias("status"), F.lit(n).cast("long").alias("batch"))
    log.append(batch(lab, "completed", 1), "1")
    pinned = snapshots.last_status(log.read())
    for _ in range(2):
        log.append(batch(lab.where("toxic = 1"), "missing", 2), "2")
    before = snapshots.last_status(log.read())
    log.compact(snapshots.last_status)
    after = snapshots.last_status(log.read())
    of = lambda rows, name: rows.select("id", F.col("status").alias(name))
    return of(before, "status").join(of(after, "compacted"), "id").join(of(pinned, "pinned"), "id")


@query("SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS keys, sum(o_custkey)::BIGINT AS customers, true AS even FROM orders")
def compact_by_size(spark, sf_dir):
    """Sixteen files of very different sizes become files of one size, each written by a task
    of its own. Hashes make the rows of a small table heavier than the overhead of a file;
    the rows of a large one need a single hash."""
    at, orders = state.scratch(spark, "skewed"), read(spark, sf_dir, "orders")
    hashes = max(1, min(16, 24_000 // max(1, orders.count())))
    rows = orders.select("o_orderkey", "o_custkey", F.concat(*[F.sha2(F.concat_ws("/", "o_orderkey", F.lit(k)), 256) for k in range(hashes)]).alias("noise"))
    part = F.least(F.floor(F.log2(1 + F.pmod(F.xxhash64("o_orderkey"), F.lit(65536)).cast("double"))), F.lit(15)).cast("int")
    rows.repartitionById(16, part).write.option("compression", "zstd").parquet(f"{at}/in")
    total = compaction.footers(spark, f"{at}/in").agg(F.sum("bytes")).first()[0]
    bins = compaction.compact_files(spark, f"{at}/in", f"{at}/out", -(-total // 6))
    sizes = [r["bytes"] for r in compaction.footers(spark, f"{at}/out").collect()]  # six
    even = len(sizes) == bins == 6 and max(abs(s - total / 6) for s in sizes) <= 0.1 * total / 6
    return spark.read.parquet(f"{at}/out").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("o_custkey").alias("customers")).withColumn("even", F.lit(even))


# -------------------------------------------------------- schemas, counters, decisions
@query("""SELECT CASE o_orderkey % 3 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey ELSE o_orderkey + 3000000000 END AS id, CASE o_orderkey % 3 WHEN 2 THEN 0 ELSE o_custkey END AS score, 3 AS scans FROM orders""")
def union_by_schema(spark, sf_dir):
    """Sixty files of three schemas, and a path that isn't there: three scans."""
    at, key = state.scratch(spark, "schemas"), F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders")
    for k, cols in enumerate(([key.alias("id"), F.col("o_custkey").alias("score")], [key.cast("string").alias("id"), F.concat(F.col("o_custkey").cast("string"), F.lit(".5")).alias("score")], [(key + F.lit(3000000000)).alias("id")])):
        rows.where(key % 3 == k).select(*cols).repartition(20).write.parquet(f"{at}/{k}")
    bound = ColumnBinding("id", None, None, None, None, None, "score", None, None, None, None)
    both = tables.parquet_union(spark, [f"{at}/0", f"{at}/1", f"{at}/none", f"{at}/2"], bound)
    scans = len(tables.schema_groups(spark, [f"{at}/{k}" for k in range(3)]))
    return both.select("id", F.coalesce("score", F.lit(0)).alias("score"), F.lit(scans).alias("scans"))


@query("""SELECT status, count(*) AS n, sum(b)::BIGINT AS bytes FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' WHEN 2 THEN 'not_found' ELSE 'completed' END AS status, p_size AS b FROM part) GROUP BY status""")
def counted_write(spark, sf_dir):
    """Outcomes are counted by the job that writes them."""
    k = F.col("id") % 4
    status = F.when(k == 0, "failed").when(k == 1, "skipped").when(k == 2, "not_found").otherwise("completed")
    got = outputs.write_counted(_part(spark, sf_dir).select("id", status.alias("status"), F.col("size").cast("long").alias("bytes")), f"{state.scratch(spark, 'counted')}")
    return spark.createDataFrame([(s, got[s], got[f"{s}_bytes"]) for s in ("completed", "failed", "skipped", "not_found")], "status string, n long, bytes long").where("n > 0")


_SEEN = "CASE p_partkey % 5 WHEN 0 THEN 'verified' WHEN 1 THEN 'missing' WHEN 2 THEN 'recovered' WHEN 3 THEN 'still_missing' ELSE 'untracked' END"


@query(f"""SELECT p_partkey AS id, {_SEEN} AS state, CASE WHEN p_partkey % 5 IN (0, 2, 4) THEN 'completed' ELSE 'missing' END AS adopting,
 CASE WHEN p_partkey % 5 IN (0, 1, 2) THEN 'completed' WHEN p_partkey % 5 = 3 THEN 'missing' END AS keeping FROM part""")
def adopt_or_drop(spark, sf_dir):
    """What a validation leaves if untracked files are adopted, and if marks of missing ones are kept."""
    ids = _part(spark, sf_dir).select("id")
    of = lambda *k: ids.where((F.col("id") % 5).isin(*k))
    states = reconcile.reconcile(of(0, 1), of(2, 3), of(0, 2, 4))
    adopting = reconcile.next_progress(states, adopt_untracked=True).withColumnRenamed("status", "adopting")
    keeping = reconcile.next_progress(states, drop_missing=False).withColumnRenamed("status", "keeping")
    return states.join(adopting, "id", "left").join(keeping, "id", "left")


@query("""SELECT row_number() OVER (ORDER BY f) AS line, f AS file_name FROM (SELECT DISTINCT p_partkey || '.png' AS f FROM part)""")
def review_order(spark, sf_dir):
    """Lines of the review sheet by file name, as they stand in its files."""
    at = state.scratch(spark, "review")
    names = _part(spark, sf_dir).select(F.concat(F.col("id").cast("string"), F.lit(".png")).alias("file_name"), F.col("name").alias("tags"))
    outputs.write_review(delta.review_sheet(delta.tag_delta(names, names)), at)
    sheet = spark.read.csv(at, header=True).select("file_name", F.col("_metadata.file_name").alias("_f"), F.monotonically_increasing_id().alias("_at"))
    window = Window.partitionBy("_f").orderBy("_at")
    inside = sheet.select("_f", "file_name", F.row_number().over(window).alias("k"))
    before = inside.groupBy("_f").agg(F.count("*").alias("n"))  # a row a file
    before = before.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(F.broadcast(before), "_f").select((F.col("before") + F.col("k")).alias("line"), "file_name")


@query("""SELECT p_partkey AS id, true AS kept_with_null, p_partkey % 4 <> 0 AS kept_without FROM part WHERE p_partkey % 4 <> 1""")
def null_urls(spark, sf_dir):
    """Items without URL pass an ending filter unless asked otherwise; videos don't."""
    k = F.col("id") % 4
    rows = _part(spark, sf_dir).select("id", F.when(k == 0, None).when(k == 1, "http://x/a.mp4").otherwise("http://x/a.png").alias("url"))
    kept = FilterSpec().apply(rows).select("id", F.lit(True).alias("kept_with_null"))
    without = FilterSpec(keep_null_url=False).apply(rows).select("id", F.lit(True).alias("w"))
    return kept.join(without, "id", "left").select("id", "kept_with_null", F.coalesce("w", F.lit(False)).alias("kept_without"))


@query("""SELECT p_partkey::VARCHAR AS id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN '{"k":' || p_size || '}' ELSE '' END AS o FROM part""")
def csv_from_json(spark, sf_dir):
    """JSON objects as lines of a CSV, a column per key, absent ones blank."""
    at, odd = state.scratch(spark, "csv_json"), F.col("id") % 2 == 1
    one = lambda *cols: F.to_json(F.struct("id", "name", *cols))
    text = F.when(odd, one()).otherwise(one(F.struct(F.col("size").alias("k")).alias("o")))
    flat = jsonops.flatten_objects(_part(spark, sf_dir).select(F.col("id").alias("file"), text.alias("text")), "text")
    outputs.write_review(jsonops.to_table(flat, ["file", "item"], ["id", "name", "o"]).drop("file", "item"), at)
    return tables.csv_strings(spark, at)


@query("""SELECT name, name IN ('score') AS lacking FROM (SELECT unnest(['id', 'tags', 'score']) AS name)
 WHERE (SELECT count(*) FROM part) > 0""")
def required_columns(spark, sf_dir):
    """Which of the required columns a table lacks is told, not passed over."""
    rows = _part(spark, sf_dir).select("id", F.col("name").alias("tag_string"))
    wanted = ("id", "tags", "score")
    try:
        ColumnBinding().canonical(rows, required=wanted)
        told = ""
    except ValueError as e:
        told = str(e)
    there = rows.where("id IS NOT NULL").agg(F.count("*").alias("n")).where("n > 0")  # a bare count would read footers only
    return there.select(F.explode(F.array(*map(F.lit, wanted))).alias("name")).select("name", F.split(F.lit(told.removeprefix("no columns for ")), ", ").alias("l")).select("name", F.array_contains("l", F.col("name")).alias("lacking"))


@query("SELECT doc_id AS id FROM documents WHERE regexp_matches(lower(coalesce(text, '')), '(^|\\s)the(\\s|$)') AND regexp_matches(lower(coalesce(text, '')), '(^|\\s)of(\\s|$)')")
def tags_from_a_list(spark, sf_dir):
    """Terms as given on a command line, between commas and blanks."""
    rows = ColumnBinding("doc_id", "text", None, None, None, None, None, None, None, None, None).canonical(read(spark, sf_dir, "documents"))
    return FilterSpec(TagRule(tuple(parse_list(" the,, of\n")))).apply(rows).select("id")

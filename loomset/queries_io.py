"""Queries for sources, sinks and saved state: written to a scratch folder, read back, compared with SQL."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import tags, values
from .operators import archive, audit, geometry, jsonops, project, reconcile, shards
from .plans.filters import ColumnBinding, FilterSpec
from .queries import QUERIES, SQL, query, read
from .sinks import outputs
from .sources import files, state, tables

__all__ = ["QUERIES", "SQL"]


def _store(folder: str):
    return _Rooted(folder)


class _Rooted:
    """A file system with the methods the sinks use, by URI."""

    def __init__(self, folder: str):
        self.store, self.inner = fs.FileSystem.from_uri(folder)
        self.prefix = folder.removesuffix(self.inner)

    def create_dir(self, path: str, recursive: bool = True) -> None:
        self.store.create_dir(path.removeprefix(self.prefix), recursive=recursive)

    def open_output_stream(self, path: str):
        return self.store.open_output_stream(path.removeprefix(self.prefix))

    def move(self, path: str, target: str) -> None:
        self.store.move(path.removeprefix(self.prefix), target.removeprefix(self.prefix))

    def delete_dir(self, path: str) -> None:
        self.store.delete_dir(path.removeprefix(self.prefix))


def _part(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))


def _dealt(spark, sf_dir) -> DataFrame:
    """The parts in ranges of ids, so many a task that each can write files for them."""
    rows = _part(spark, sf_dir)
    return rows.repartitionByRange(max(1, -(-rows.count() // 5_000)), "id")


@query("SELECT p_partkey AS id, p_name AS name, p_size::VARCHAR AS size FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, lower(p_name), NULL FROM part WHERE p_partkey % 3 <> 0")
def source_parquet_union(spark, sf_dir):
    """Files of different types and columns, a missing one skipped."""
    at, part = state.scratch(spark, "union"), _part(spark, sf_dir)
    part.where("id % 3 = 0").select("id", F.col("name").alias("rating"), F.col("size").cast("string").alias("score")).write.parquet(f"{at}/a")
    part.where("id % 3 <> 0").select(F.col("id").cast("int").alias("id"), F.col("name").alias("rating")).write.parquet(f"{at}/b")
    bound = ColumnBinding("id", None, None, None, None, None, "score", "rating", None, None, None)
    both = tables.parquet_union(spark, [f"{at}/a", f"{at}/none", f"{at}/b"], bound)
    names = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("raw"))
    rows = both.join(names, "id").select("id", F.when(F.col("id") % 3 == 0, F.col("raw")).otherwise(F.col("rating")).alias("name"), F.col("score").cast("string").alias("size"))
    return rows


@query("SELECT column_name AS name, n FROM (DESCRIBE part), (SELECT count(*) AS n FROM part)")
def source_parquet_columns(spark, sf_dir):
    """Column names of a folder of Parquet files, from footers, and the rows that have them."""
    at = state.scratch(spark, "columns")
    read(spark, sf_dir, "part").write.parquet(f"{at}/deep/er")
    names = spark.createDataFrame([(c,) for c in tables.parquet_columns(spark, at)], "name string")
    return names.join(F.broadcast(tables.parquet_directory(spark, at).agg(F.count("*").alias("n"))), how="cross")


@query("SELECT p_brand AS brand, p_partkey AS id FROM part")
def source_parquet_directory(spark, sf_dir):
    at = state.scratch(spark, "shards")
    for k in range(3):
        _part(spark, sf_dir).where(f"id % 3 = {k}").select("id", "brand").write.parquet(f"{at}/shard_{k}")
    return tables.parquet_directory(spark, at).select("brand", "id")


@query("""SELECT p_partkey::VARCHAR AS id, 'a "' || p_name || '",' || chr(10) || 'b' AS name, CASE WHEN p_partkey % 3 = 0 THEN '\\\\' || p_brand WHEN p_partkey % 3 = 2 THEN p_brand ELSE '' END AS brand FROM part""")
def csv_round_trip(spark, sf_dir):
    """Quotes, line feeds and empty values survive the review sheet and the string reader."""
    at = state.scratch(spark, "csv")
    name = F.concat(F.lit('a "'), "name", F.lit('",\nb'))
    rows = _part(spark, sf_dir).select("id", name.alias("name"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("\\\\"), "brand")).when(F.col("id") % 3 == 2, F.col("brand")).when(F.col("id") % 6 == 1, "").alias("brand"))
    outputs.write_review(rows, at)
    return tables.csv_strings(spark, at)


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def jsonl_round_trip(spark, sf_dir):
    at = state.scratch(spark, "jsonl")
    outputs.write_jsonl(_part(spark, sf_dir).select("id", "name"), at)
    return spark.read.schema("id long, name string").json(at)


@query("SELECT p_partkey AS id, p_name AS name, p_brand AS shard FROM part")
def sharded_json_round_trip(spark, sf_dir):
    at = state.scratch(spark, "sharded")
    outputs.write_sharded_json(_part(spark, sf_dir).select("id", "name", F.col("brand").alias("shard")), at)
    return spark.read.schema("id long, name string, shard string").json(at).select("id", "name", "shard")


def _sidecars(spark, sf_dir) -> str:
    """A sidecar per part in shard folders; returns the folder."""
    at = state.scratch(spark, "sidecars")
    rows = _part(spark, sf_dir).select(values.shard_name(F.col("id"), 50).alias("shard"), "id", F.to_json(F.struct("id", "name")).alias("json"))
    outputs.write_sidecars(rows, _store, at).count()
    return at


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def sidecar_files(spark, sf_dir):
    """A file per item, renamed into place, then read as a JSON tree."""
    texts = files.json_texts(spark, _sidecars(spark, sf_dir)).select(F.from_json("text", "id long, name string").alias("o"))
    return texts.select("o.*")


@query("SELECT p_partkey AS id, printf('shard_%05d', p_partkey // 50) AS shard FROM part")
def inventory_shard_ids(spark, sf_dir):
    return files.shard_ids(files.inventory(spark, _sidecars(spark, sf_dir), True), "json")


@query("SELECT p_partkey || '.json' AS name FROM part")
def inventory_by_extension(spark, sf_dir):
    return files.listed(files.inventory(spark, _sidecars(spark, sf_dir), True), [".json"]).select("name")


@query("SELECT p_partkey AS id, printf('shard_%05d', p_partkey // 50) AS shard FROM part")
def pair_files(spark, sf_dir):
    """Image and sidecar of an item written together; any file with a digit stem counts."""
    at = state.scratch(spark, "pairs")
    rows = _dealt(spark, sf_dir).select(values.shard_name(F.col("id"), 50).alias("shard"), "id", F.lit(".png").alias("ext"), F.encode("name", "UTF-8").alias("content"), F.lit("{}").alias("json"))
    outputs.write_pairs(rows, _store, at).count()
    found = files.inventory(spark, at, True)
    return files.shard_ids(found, "any").join(files.shard_ids(found), ["id", "shard"]).join(files.shard_ids(found, "json"), ["id", "shard"])


def packed_tars(rows: DataFrame, at: str) -> None:
    """An archive t{k}.tar of each k of (k, id, name) with a member in/{id}.jpg per row."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        data = io.BytesIO()
        with tarfile.open(fileobj=data, mode="w") as tar:
            for i, name in sorted(zip(group["id"], group["name"])):
                info = tarfile.TarInfo(f"in/{i}.jpg")
                info.size = len(name.encode())
                tar.addfile(info, io.BytesIO(name.encode()))
        store = _Rooted(at)
        store.create_dir(at)
        with store.open_output_stream(f"{at}/t{group['k'].iloc[0]}.tar") as out:
            out.write(data.getvalue())
        return pd.DataFrame({"k": [group["k"].iloc[0]]})

    rows.groupBy("k").applyInPandas(pack, "k int").count()


def _tars(spark, sf_dir) -> str:
    """An archive per 500 parts."""
    at = state.scratch(spark, "tars")
    packed_tars(_part(spark, sf_dir).select(F.floor(F.col("id") / 500).cast("int").alias("k"), "id", "name"), at)
    return at


_TAR = "SELECT 't' || p_partkey // 500 || '.tar' AS archive, 'in/' || p_partkey || '.jpg' AS member, strlen(p_name)::BIGINT AS size, row_number() OVER (PARTITION BY p_partkey // 500 ORDER BY p_partkey) - 1 AS pos, p_partkey AS image_id FROM part"


@query(_TAR)
def tar_member_index(spark, sf_dir):
    """Members by their headers, archive by archive."""
    return files.tar_members(spark, _tars(spark, sf_dir))


@query(f"SELECT count(DISTINCT archive) AS n_archives, count(DISTINCT image_id) AS n_ids FROM ({_TAR})")
def index_cache_statistics(spark, sf_dir):
    """The index is written once and read back instead of scanning archives again."""
    at = state.scratch(spark, "index")
    outputs.write_index_cache(files.tar_members(spark, _tars(spark, sf_dir), stream=False).withColumnRenamed("member", "inner_path"), at)
    return archive.index_statistics(state.index_cache(spark, at))


@query("SELECT p_partkey AS image_id, 't' || (p_partkey + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END) % 5 || '.tar' AS archive, NULL::VARCHAR AS inner_path FROM part")
def cached_index_import(spark, sf_dir):
    """Cache files of the replaced tools: keys with an extension, repeated ids (the last wins), keys that are no id."""
    i = F.col("p_partkey")
    rows = read(spark, sf_dir, "part").select(i.alias("id"), F.concat(F.lit("t"), (i % 5).cast("string"), F.lit(".tar")).alias("tar"), F.concat(F.lit("t"), ((i + 1) % 5).cast("string"), F.lit(".tar")).alias("next"))
    own = F.struct(F.col("id").cast("string").alias("key"), F.col("tar").alias("value"))
    more = F.when(F.col("id") % 7 == 0, F.struct(F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("key"), F.col("next").alias("value")))
    odd = F.struct(F.concat(F.lit("d/"), F.col("id").cast("string"), F.lit(".jpg")).alias("key"), F.col("tar").alias("value"))
    texts = rows.select(F.to_json(F.struct(F.map_from_entries(F.filter(F.array(own, more, odd), lambda x: x.isNotNull())).alias("image_to_tar"))).alias("text"))
    return state.cached_index(texts)


@query("SELECT 'a.tar' AS archive, p_partkey AS image_id, CASE p_partkey % 3 WHEN 2 THEN 'in/' || p_partkey || '.png' ELSE p_partkey || '.jpg' END AS inner_path FROM part")
def manifest_import(spark, sf_dir):
    """Manifests that list names, map names to details, or map ids to paths."""
    i = F.col("p_partkey").cast("string")
    name = F.concat(i, F.lit(".jpg"))
    shape = F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.struct(F.array(name).alias("files")))).when(F.col("p_partkey") % 3 == 1, F.to_json(F.map_from_arrays(F.array(name), F.array(F.struct(F.lit(1).alias("size")))))).otherwise(F.to_json(F.map_from_arrays(F.array(i), F.array(F.concat(F.lit("in/"), i, F.lit(".png"))))))
    return files.manifest_entries(read(spark, sf_dir, "part").select(shape.alias("text")), F.lit("a.tar"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_partkey // 200 ELSE (row_number() OVER (PARTITION BY p_partkey % 2 ORDER BY p_partkey) - 1 + (SELECT max(p_partkey) FILTER (p_partkey % 2 = 0) // 2 + 1 FROM part)) // 100 END AS shard FROM part")
def shard_manifest_resume(spark, sf_dir):
    """Known ids keep their shard after the manifest is written and read back; new ids go on in the last one."""
    at, ids = state.scratch(spark, "manifest"), _part(spark, sf_dir).select("id")
    outputs.write_manifest(ids.where("id % 2 = 0").withColumn("shard", F.floor(F.col("id") / 200)), at)
    known = spark.read.schema("id long, shard long").parquet(at)
    return shards.by_count(ids, known, 100, *state.manifest_state(known))


@query("SELECT p_partkey AS id, p_partkey // 70 AS shard FROM part")
def shard_manifest_import(spark, sf_dir):
    rows = _part(spark, sf_dir).select(F.to_json(F.struct(F.map_from_arrays(F.array(F.col("id").cast("string")), F.array(F.floor(F.col("id") / 70))).alias("id_to_shard"))).alias("text"))
    return state.shard_manifest(rows)


@query("SELECT p_partkey AS id, p_partkey // 50 AS shard FROM part WHERE p_partkey % 4 <> 0")
def shard_manifest_rebuild(spark, sf_dir):
    """From an inventory: images in shard folders, other names and types left out."""
    k = F.col("id")
    ext = F.when(k % 4 == 0, ".json").when(k % 4 == 1, ".png").otherwise(".jpg")
    found = _part(spark, sf_dir).select(values.shard_name(k, 50).alias("shard"), k.cast("string").alias("stem"), ext.alias("ext"))
    odd = found.where("stem % 5 = 0").select(F.lit("other").alias("shard"), F.concat(F.lit("x"), "stem").alias("stem"), "ext")
    return state.rebuilt_manifest(found.unionByName(odd))


@query("SELECT status, id, row_number() OVER (PARTITION BY status ORDER BY id) - 1 AS place FROM (SELECT CASE WHEN quality = 1 THEN 'completed' ELSE 'missing' END AS status, doc_id AS id FROM labels)")
def progress_lists(spark, sf_dir):
    """The progress table in order of status and id, read back with each id's place in its list."""
    at = state.scratch(spark, "progress")
    rows = read(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "completed").otherwise("missing").alias("status"), F.col("doc_id").alias("id"))
    outputs.write_progress(rows.unionByName(rows.where("id % 5 = 0")), at)
    back = spark.read.schema("status string, id long").parquet(at)
    parts = [shards.global_rank(back.where(F.col("status") == s), "id", "place") for s in ("completed", "missing")]
    return parts[0].unionByName(parts[1])


@query("SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'completed' ELSE 'missing' END AS status FROM labels")
def progress_import(spark, sf_dir):
    """Progress files of the replaced tools; an absent list is empty."""
    at = state.scratch(spark, "progress_json")
    lab = read(spark, sf_dir, "labels")
    lists = [F.collect_list(F.when(F.col("quality") == 1, F.col("doc_id"))).alias("completed_ids"), F.collect_list(F.when(F.col("quality") != 1, F.col("doc_id"))).alias("missing_ids")]
    texts = lab.groupBy(F.floor(F.col("doc_id") / 1000).alias("k")).agg(*lists).select(F.to_json(F.struct(F.when(F.size("completed_ids") > 0, F.col("completed_ids")).alias("completed_ids"), "missing_ids")).alias("value"))
    texts.write.option("maxRecordsPerFile", 1).text(at)
    return files.progress(spark, at)


@query("SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'missing' ELSE 'completed' END AS status FROM labels")
def status_table(spark, sf_dir):
    """Appended batches: the last one of an id is its status."""
    at, lab = state.scratch(spark, "status"), read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    outputs.append_status(lab.withColumns({"status": F.lit("completed"), "batch": F.lit(1).cast("long")}), at)
    outputs.append_status(lab.where("toxic = 1").withColumns({"status": F.lit("missing"), "batch": F.lit(2).cast("long")}), at)
    return outputs.current_status(spark, at)


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def compact_round_trip(spark, sf_dir):
    at = state.scratch(spark, "compact")
    outputs.compact_parquet(_part(spark, sf_dir).select("id", "name"), at)
    return spark.read.parquet(at)


@query("""SELECT count(*) FILTER (c) AS marked_complete, count(*) FILTER (c AND d) AS verified, count(*) FILTER (c AND NOT d) AS missing, count(*) FILTER (c AND d AND m) AS recovered,
 count(*) FILTER (d AND NOT c) AS untracked, count(*) FILTER (m AND NOT c AND NOT d) AS still_missing
 FROM (SELECT coalesce(quality = 1, false) AS c, coalesce(toxic = 0, false) AS d, d.doc_id % 10 = 3 AS m FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def validation_counts(spark, sf_dir):
    lab, docs = read(spark, sf_dir, "labels"), read(spark, sf_dir, "documents")
    return reconcile.validation_counts(lab.where("quality = 1"), docs.where("doc_id % 10 = 3"), lab.where("toxic = 0"), "doc_id")


@query("SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0")
def refetch_after_cleanup(spark, sf_dir):
    lab = read(spark, sf_dir, "labels")
    return reconcile.completed_after_cleanup(lab.where("quality = 1").select("doc_id"), lab.where("toxic = 1"), "doc_id")


_KIND = "CASE WHEN p_partkey % 3 = 0 THEN 'json' ELSE 'image' END"
_OUT = "CASE WHEN p_partkey % 10 = 0 THEN 'failed: denied' WHEN p_partkey % 10 = 1 THEN 'planned' ELSE 'done' END"


@query(f"""SELECT count(*) FILTER (o = 'done' AND k = 'image') AS removed_images, count(*) FILTER (o = 'done' AND k = 'json') AS removed_jsons,
 coalesce(sum(p_size) FILTER (o = 'done' AND k = 'image'), 0)::BIGINT AS removed_size, count(DISTINCT p_partkey // 2) FILTER (o = 'done' AND k = 'image') AS removed_ids,
 count(*) FILTER (o = 'failed: denied') AS failures FROM (SELECT *, {_KIND} AS k, {_OUT} AS o FROM part)""")
def removal_statistics(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 2).alias("id"), F.expr(_KIND).alias("kind"), F.col("p_size").cast("bigint").alias("size"), F.expr(_OUT).alias("outcome"))
    return audit.removal_statistics(rows)


@query("SELECT p_partkey AS id, 'delete' AS action FROM part WHERE p_partkey % 4 IN (1, 2)")
def removal_plan(spark, sf_dir):
    kind = F.when(F.col("id") % 4 == 1, "corrupt").when(F.col("id") % 4 == 2, "orphan_json").otherwise("valid")
    return audit.removal_plan(_part(spark, sf_dir).select("id", kind.alias("class"))).select("id", "action")


@query("SELECT status, count(*) AS n, sum(p_size)::BIGINT AS bytes FROM (SELECT p_brand AS status, p_size FROM part) GROUP BY status")
def outcome_counts(spark, sf_dir):
    return audit.outcome_counts(_part(spark, sf_dir).select(F.col("brand").alias("status"), F.col("size").cast("bigint").alias("bytes")))


_BAD = "(page_id % 4 = 1 OR (page_id % 4 = 2 AND strlen(html) < 100) OR page_id % 4 = 3)"


@query(f"SELECT page_id AS id FROM (SELECT * FROM pages ORDER BY page_id LIMIT 1000) WHERE page_id % 5 <> 0 AND {_BAD}")
def invalid_sample(spark, sf_dir):
    """Stored files with a wrong MD5, too small without one, or gone; ids without metadata aren't judged."""
    k, pages = F.col("page_id") % 4, read(spark, sf_dir, "pages").withColumn("id", F.col("page_id"))
    claimed = F.when(k == 0, F.upper(F.md5("html"))).when(k == 1, F.lit("0"))
    stored = pages.where("page_id % 4 <> 3").select("id", F.octet_length("html").cast("bigint").alias("size"), F.md5("html").alias("actual_md5"))
    return reconcile.invalid_sample(pages, pages.where("page_id % 5 <> 0").select("id", claimed.alias("md5")), stored)


@query("SELECT p_brand AS dir, p_partkey || '.png' AS old_name, p_partkey || '_x.png' AS new_name, p_partkey || '.json' AS json_name, p_partkey || '_x.json' AS new_json_name FROM part WHERE p_partkey % 3 <> 0")
def sidecar_join(spark, sf_dir):
    """Images meet the sidecar of their folder and stem; those without one stay out of the rename."""
    rows = _part(spark, sf_dir).select(F.col("brand").alias("dir"), F.col("id").cast("string").alias("stem"))
    sidecars = rows.where("stem % 3 <> 0").withColumn("ext", F.lit(".json")).unionByName(rows.where("stem % 3 = 0").withColumn("ext", F.lit(".txt")))
    return project.rename_plan(project.with_sidecar(rows.withColumn("ext", F.lit(".png")), sidecars), "_x")


@query("""SELECT 'd' AS dir, p_partkey::VARCHAR AS stem, (k + 1)::INTEGER AS crop, p_partkey || '_' || k + 1 || '.png' AS image_name, (least(200, k * 82))::INTEGER AS x, 0 AS y, 100 AS side,
 CASE WHEN p_partkey % 2 = 0 THEN p_partkey || '.json' END AS json_name, CASE WHEN p_partkey % 2 = 0 THEN p_partkey || '_' || k + 1 || '.json' END AS json_copy
 FROM part, (SELECT unnest([0, 1, 2]) AS k)""")
def crop_sidecars(spark, sf_dir):
    """Every crop of a 300 by 100 image and the copy of its sidecar, if it has one."""
    stem = F.col("id").cast("string")
    rows = _part(spark, sf_dir).select(F.lit("d").alias("dir"), stem.alias("stem"), F.lit(".png").alias("ext"), F.lit(300).alias("w"), F.lit(100).alias("h"), F.when(F.col("id") % 2 == 0, F.concat(stem, F.lit(".json"))).alias("json_name"))
    return geometry.crop_files(rows)


@query("SELECT p_brand AS dir, p_partkey::VARCHAR AS stem, CASE WHEN p_partkey % 3 = 0 THEN p_partkey || '.jpg' WHEN p_partkey % 3 = 1 THEN p_partkey || '.webp' END AS image FROM part")
def first_image_of_sidecar(spark, sf_dir):
    rows = _part(spark, sf_dir).select(F.col("brand").alias("dir"), F.col("id").cast("string").alias("stem"))
    some = lambda keep, ext: rows.where(keep).select("dir", "stem", F.lit(ext).alias("ext"), F.concat("stem", F.lit(ext)).alias("name"))
    images = some("stem % 3 = 0", ".webp").unionByName(some("stem % 3 = 0", ".jpg")).unionByName(some("stem % 3 = 1", ".webp")).unionByName(some("stem % 3 = 2", ".txt"))
    return archive.first_by_extension(rows, images)


@query("SELECT o_custkey AS id, max(o_orderkey)::VARCHAR AS value FROM orders GROUP BY o_custkey")
def last_writer(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").cast("string").alias("value"), F.col("o_orderkey").alias("at"))
    return archive.last_writer(rows, "id", "value", "at")


@query("SELECT p_partkey || '.png' AS filename, CASE p_partkey % 4 WHEN 0 THEN 'safe' WHEN 1 THEN 'questionable' WHEN 2 THEN 'explicit' ELSE 'odd' END AS rating, p_name AS tags FROM part")
def sidecar_from_ready_columns(spark, sf_dir):
    k = F.col("id") % 4
    rating = F.when(k == 0, " General").when(k == 1, "Q").when(k == 2, "nsfw").otherwise("Odd ")
    rows = _part(spark, sf_dir).select(F.concat(F.col("id").cast("string"), F.lit(".png")).alias("file"), rating.alias("r"), "name")
    return project.sidecar_direct(rows, "file", "r", "name")


@query("SELECT doc_id, regexp_replace(regexp_replace(replace(text, ',', ' '), '\\s\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS cleaned FROM documents")
def comma_and_space_clean(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", tags.clean_spaces(F.col("text")).alias("cleaned"))


@query("SELECT p_partkey AS id, p_partkey || '_x.png' AS file_name, p_name AS name FROM part")
def json_file_name_patch(spark, sf_dir):
    text = F.to_json(F.struct(F.lit("old.png").alias("file_name"), "name"))
    rows = _part(spark, sf_dir).select("id", jsonops.patch_file_name(text, F.concat(F.col("id").cast("string"), F.lit("_x.png"))).alias("text"))
    return rows.select("id", F.get_json_object("text", "$.file_name").alias("file_name"), F.get_json_object("text", "$.name").alias("name"))


@query("SELECT count(*) AS n FROM documents WHERE n_chars >= 500")
def dry_run_count(spark, sf_dir):
    """How many items a filter would take, without taking them."""
    bound = ColumnBinding("doc_id", None, None, None, None, None, "n_chars", None, None, None, None).canonical(read(spark, sf_dir, "documents"))
    return FilterSpec(min_score=500).apply(bound).agg(F.count("*").alias("n"))


@query("SELECT archive, id, row_number() OVER (PARTITION BY archive ORDER BY id) - 1 AS place FROM (SELECT 'a' || o_orderkey % 9 || '.tar' AS archive, o_orderkey AS id FROM orders)")
def extraction_order(spark, sf_dir):
    """Each archive's items together and in order: a task numbers them as they come."""
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("a"), (F.col("o_orderkey") % 9).cast("string"), F.lit(".tar")).alias("archive"))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, place = None, 0
        for batch in batches:
            places = []
            for name in batch["archive"]:
                now, place = (name, place + 1) if name == now else (name, 0)
                places.append(place)
            yield batch.assign(place=places)

    return archive.extraction_order(rows).select("archive", "id").mapInPandas(number, "archive string, id long, place long")


@query("""WITH a AS (SELECT 'd' || p_partkey * 37 || '.tar' AS archive, (p_partkey * 37)::VARCHAR AS digits FROM part),
 p AS (SELECT archive, substr(digits, i, n) AS piece FROM a, range(1, 20) AS x(i), range(1, 20) AS y(n) WHERE i + n - 1 <= length(digits)),
 f AS (SELECT piece, min(archive) AS archive FROM p GROUP BY piece)
 SELECT o_orderkey AS id, least(w.archive, h.archive) AS archive FROM orders LEFT JOIN f w ON w.piece = o_orderkey::VARCHAR LEFT JOIN f h ON h.piece = substr(o_orderkey::VARCHAR, 1, 3)""")
def archive_by_name(spark, sf_dir):
    """The guess by name: an archive whose digits hold the id or its first three digits."""
    names = _part(spark, sf_dir).select(F.concat(F.lit("d"), (F.col("id") * 37).cast("string"), F.lit(".tar")).alias("archive"))
    return archive.resolve_by_name(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), names)


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN p_size END::INTEGER AS width, CASE WHEN p_partkey % 5 = 1 THEN 7 END::INTEGER AS height,
 CASE p_partkey % 5 WHEN 0 THEN 'file_not_found' WHEN 1 THEN NULL WHEN 2 THEN 'decompression_bomb' ELSE 'not_an_image' END AS error
 FROM (SELECT * FROM part WHERE p_partkey % 5 <> 2) UNION ALL SELECT p_partkey, 60000, 60000, 'decompression_bomb' FROM part WHERE p_partkey % 5 = 2""")
def image_headers(spark, sf_dir):
    """Sizes from header bytes; huge, cut short and foreign content."""
    k = F.col("id") % 5
    png = lambda w, h: F.unhex(F.concat(F.lit("89504E470D0A1A0A" + "00" * 8), F.lpad(F.hex(w), 8, "0"), F.lpad(F.hex(h), 8, "0")))
    content = F.when(k == 1, png(F.col("size"), F.lit(7))).when(k == 2, png(F.lit(60000), F.lit(60000))).when(k == 3, F.unhex(F.lit("89504E470D0A1A0A00"))).when(k == 4, F.encode("name", "UTF-8"))
    return _part(spark, sf_dir).select("id", files.image_probe(content).alias("p")).select("id", "p.*")


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN 'failed' WHEN p_partkey % 5 = 0 THEN 'not_found' ELSE 'completed' END AS status, CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 THEN 'x' || p_partkey END AS content FROM part")
def fetch_by_id(spark, sf_dir):
    """A supplied fetch: items that aren't there, and ones that fail in every try or only in the first."""

    def fetch(item: int, tried: set = set()) -> bytes | None:  # noqa: B006
        if item % 7 == 0 or item % 3 == 0 and item not in tried:
            tried.add(item)
            raise OSError("refused")
        return None if item % 5 == 0 else b"x%d" % item

    got = outputs.fetch_items(_part(spark, sf_dir).select("id"), fetch, wait=0.0)
    return got.select("id", "status", F.decode("content", "UTF-8").alias("content"))


@query("""SELECT p_partkey::VARCHAR AS path, CASE WHEN p_partkey % 3 = 0 THEN 'none' ELSE 'delete' END AS action, 'planned' AS rehearsed,
 CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 4 = 0 THEN 'failed: denied' ELSE 'done' END AS outcome FROM part""")
def plan_and_act(spark, sf_dir):
    """A plan is only reported until it is committed; an error of one row doesn't stop the others."""

    def act(action: str, path: str, target: str | None) -> None:
        if int(path) % 4 == 0:
            raise OSError("denied")

    plan = _part(spark, sf_dir).select(F.when(F.col("id") % 3 == 0, "none").otherwise("delete").alias("action"), F.col("id").cast("string").alias("path"), F.lit(None).cast("string").alias("target"))
    dry = outputs.run_plan(plan, act).select("path", F.col("outcome").alias("rehearsed"))
    return outputs.run_plan(plan, act, commit=True).join(dry, "path").select("path", "action", "rehearsed", "outcome")


@query("SELECT p_partkey AS id FROM part WHERE p_partkey % 4 IN (0, 1)")
def malformed_json_keyword(spark, sf_dir):
    """Text that is no JSON is searched for the quoted keyword; keys and parts of words don't count."""
    k = F.col("id") % 4
    text = F.when(k == 0, '{"a": ["x", " CAT "}').when(k == 1, '{"b": {"c": "cat"}}').when(k == 2, '{"a": "cats", "cat": ').otherwise('{"cat": "dog"}')
    return _part(spark, sf_dir).where(jsonops.contains_keyword(text, "cat")).select("id")


@query("SELECT p_partkey AS id, p_partkey % 4 <> 1 AND p_partkey % 4 <> 3 AS ok FROM part")
def stored_integrity(spark, sf_dir):
    """Near the expected size, of the given MD5 where there is one, else not tiny."""
    k = F.col("id") % 4
    size = F.when(k == 3, F.lit(20)).otherwise(F.lit(1000)).cast("bigint")
    expected = F.when(k == 0, F.lit(1090)).when(k == 1, F.lit(1101)).cast("bigint")
    md5 = F.when(k == 2, F.upper(F.md5(F.encode("name", "UTF-8"))))
    return _part(spark, sf_dir).select("id", audit.stored_ok(size, expected, F.md5(F.encode("name", "UTF-8")), md5).alias("ok"))


@query("SELECT 'completed' AS status, count(*) AS n FROM labels WHERE quality = 1 HAVING count(*) > 0 UNION ALL SELECT 'missing', count(*) FROM labels WHERE quality = 0 HAVING count(*) > 0")
def next_progress_counts(spark, sf_dir):
    """What a validation leaves: completed what is on disk, missing what is not."""
    lab = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    states = reconcile.reconcile(lab, lab.where("id < 0"), lab.where("quality = 1"))
    return reconcile.next_progress(states).groupBy("status").agg(F.count("*").alias("n"))


from . import queries_files  # noqa: E402, F401  registers its queries; it builds on the helpers above

"""One query per reference operator over the driver's tables, with its SQL.

Stand-ins: documents (text as tags, lang as rating, n_chars as score), labels
(the completed part of documents), orders (ids for sharding), part (geometry and
short tags), pages (URLs), events (JSON), conversations (grouped sets).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import tags, values
from .operators import archive, audit, delta, geometry, jsonops, project, reconcile, shards
from .plans.filters import ColumnBinding, FilterSpec, TagRule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DOCUMENTS = ColumnBinding("doc_id", "text", None, None, "source", None, "n_chars", "lang_rating", None, None, None)
ITEMS = ("id", "score")


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.when(F.col("lang") == "en", "s").when(F.col("lang") == "de", "Q").when(F.col("lang") == "fr", "explicit").otherwise("nsfw")
    return read(spark, sf_dir, "documents").withColumn("lang_rating", rating)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DOCUMENTS.canonical(_rated(spark, sf_dir))


# rating stand-in in SQL
_R = "CASE lang WHEN 'en' THEN 's' WHEN 'de' THEN 'q' WHEN 'fr' THEN 'explicit' ELSE 'nsfw' END"
_D = f"(SELECT doc_id AS id, lower(coalesce(text, '')) AS tags, lower(source) AS artist, n_chars AS score, {_R} AS rating FROM documents)"
_NB, _NE = r"(^|[^\p{L}\p{M}\p{N}\p{Pc}])", r"([^\p{L}\p{M}\p{N}\p{Pc}]|$)"
_SB, _SE = r"(^|\s)", r"(\s|$)"


def _tagged(spark, sf_dir, spec: FilterSpec) -> DataFrame:
    return spec.apply_raw(_rated(spark, sf_dir), DOCUMENTS).select("id", "score")


def _where(predicate: str) -> str:
    return f"SELECT id, score FROM {_D} WHERE {predicate}"


def _m(body: str, col: str = "tags") -> str:
    return f"regexp_matches({col}, '{body}')"


@query(_where(_m(_NB + "the" + _NE) + " AND " + _m(_NB + "of" + _NE)))
def tag_include_all_word(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(("the", "OF")), dialect="word"))


@query(_where(_m(_SB + "the" + _SE) + " AND " + _m(_SB + "of" + _SE)))
def tag_include_all_token(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(("the", "of"))))


@query(_where(_m(f"{_SB}(das|les){_SE}")))
def tag_include_any(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(include_any=("das", "les"))))


@query(_where("NOT " + _m(f"{_SB}(by|der|con){_SE}")))
def tag_exclude(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(exclude=("by", "der", "con"))))


@query(_where(_m(_SB + "ther")))
def tag_prefix(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(("ther*",))))


@query(_where(_m("keit" + _SE)))
def tag_suffix(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(("*keit",))))


@query(_where("contains(tags, 'eaux')"))
def tag_substring(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(TagRule(("*eaux*",))))


@query(_where(_m(f"{_NB}(src1|src2){_NE}", "artist") + " OR (starts_with(artist, 'src3') AND artist <> 'src30')"))
def attr_tags_any_none(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(artist=TagRule(include_any=("src1", "src2", "src3*"), exclude=("src30",)), dialect="word"))


@query(_where("score >= 500"))
def score_min(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(min_score=500))


@query(_where("rating IN ('s', 'safe', 'q', 'questionable')"))
def rating_in_4class(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(ratings=("safe", "Q")))


@query(_where("rating IN ('explicit', 'e', 'nsfw')"))
def rating_in_3class(spark, sf_dir):
    return _tagged(spark, sf_dir, FilterSpec(ratings=("explicit",), rating_classes=3))


def _sized(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") * 40).alias("width"), ((F.col("p_partkey") % 50 + 1) * 40).cast("int").alias("height"))


_P = "(SELECT p_partkey AS id, p_size * 40 AS width, ((p_partkey % 50 + 1) * 40)::INTEGER AS height FROM part)"


@query(f"SELECT * FROM {_P} WHERE width = height AND width >= 400")
def dims_square(spark, sf_dir):
    return FilterSpec(square=True, min_square=400).apply(_sized(spark, sf_dir))


@query(f"SELECT * FROM {_P} WHERE width >= 200 AND width <= 1600 AND height >= 400")
def dims_range(spark, sf_dir):
    return FilterSpec(min_width=200, max_width=1600, min_height=400).apply(_sized(spark, sf_dir))


_CLIP = "CASE page_id % 6 WHEN 0 THEN url || '.mp4' WHEN 1 THEN url || '.swf' WHEN 2 THEN url || '.ZIP' ELSE url END"


@query(f"""SELECT page_id, url FROM (SELECT page_id, {_CLIP} AS url FROM pages) WHERE NOT (ends_with(coalesce(url, ''), '5') OR ends_with(coalesce(url, ''), '#top')
 OR ends_with(coalesce(url, ''), '.zip') OR ends_with(coalesce(url, ''), '.mp4') OR ends_with(coalesce(url, ''), '.webm') OR ends_with(coalesce(url, ''), '.swf'))""")
def ext_exclude(spark, sf_dir):
    """The given endings, and those of videos and archives, which are always left out."""
    return FilterSpec(exclude_extensions=("5", "#top")).apply(read(spark, sf_dir, "pages").select("page_id", F.expr(_CLIP).alias("url")))


@query(_where(f"score >= 200 AND rating IN ('s', 'safe', 'q', 'questionable') AND {_m(_SB + 'the' + _SE)} AND NOT {_m(_SB + '(by|clown)' + _SE)}"))
def filter_combined(spark, sf_dir):
    spec = FilterSpec(TagRule(("the",), exclude=("by", "clown")), min_score=200, ratings=("s", "q"))
    return _tagged(spark, sf_dir, spec)


_TXT = "CASE event_id % 5 WHEN 0 THEN user_id || '.7' WHEN 1 THEN 'abc' WHEN 2 THEN NULL WHEN 3 THEN user_id::VARCHAR ELSE '1e3' END"


def _loose(spark, sf_dir) -> DataFrame:
    k = F.col("event_id") % 5
    text = F.when(k == 0, F.concat(F.col("user_id").cast("string"), F.lit(".7"))).when(k == 1, "abc").when(k == 3, F.col("user_id").cast("string")).when(k == 4, "1e3")
    return read(spark, sf_dir, "events").select("event_id", text.alias("text"))


@query(f"SELECT event_id, coalesce(trunc(try_cast({_TXT} AS DOUBLE))::BIGINT, 0) AS n FROM events")
def lenient_int_a(spark, sf_dir):
    return _loose(spark, sf_dir).select("event_id", values.lenient_int(F.col("text")).alias("n"))


@query("""SELECT l_orderkey AS id, l_linenumber AS line, trunc(l_quantity * 1.5)::BIGINT AS score, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE trunc(l_extendedprice)::BIGINT END AS width FROM lineitem""")
def strict_numbers(spark, sf_dir):
    """The null policy over double columns: fractions are cut, null is -1 for a score and 0 for a side."""
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("double") * 1.5).alias("q"), F.when(F.col("l_linenumber") % 2 == 1, F.col("l_extendedprice").cast("double")).alias("p"))
    bound = ColumnBinding("l_orderkey", None, None, None, None, None, "q", "l_linenumber", "p", None, None).canonical(rows, "null")
    return bound.select("id", F.col("rating").cast("int").alias("line"), "score", "width")


@query(f"SELECT event_id, CASE WHEN t IS NULL THEN -1 WHEN regexp_matches(t, '^-?[0-9]+$') THEN t::BIGINT END AS n FROM (SELECT event_id, {_TXT} AS t FROM events)")
def lenient_int_b(spark, sf_dir):
    return _loose(spark, sf_dir).select("event_id", values.strict_int(F.col("text"), -1).alias("n"))


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN 'safe' WHEN 'de' THEN 'questionable' WHEN 'fr' THEN 'explicit' ELSE 'unknown' END AS r4,
 CASE lang WHEN 'en' THEN 'safe' WHEN 'de' THEN 'questionable' ELSE 'explicit' END AS r3 FROM documents""")
def rating_normalize(spark, sf_dir):
    raw = F.when(F.col("lang") == "en", " S").when(F.col("lang") == "de", "Q").when(F.col("lang") == "fr", "Explicit").otherwise("nsfw ")
    return read(spark, sf_dir, "documents").select("doc_id", values.rating4(raw).alias("r4"), values.rating3(raw).alias("r3"))


_EXT = "regexp_extract(lower(url), '[^/.][^/]*(\\.[^./]*)$', 1)"


@query(f"""SELECT page_id || CASE WHEN {_EXT} IN ('.jpg', '.jpeg', '.png', '.webp', '.gif') THEN {_EXT} ELSE '.jpg' END AS filename,
 'unknown' AS rating, trim(concat_ws(' ', split_part(url, '/', 3), split_part(url, '/', 4), '')) AS tags FROM pages""")
def sidecar_compact(spark, sf_dir):
    part = lambda i: F.coalesce(F.get(F.split("url", "/"), i), F.lit(""))
    rows = read(spark, sf_dir, "pages").withColumns({"host": part(2), "section": part(3), "none": F.lit(""), "rating": F.lit(None).cast("string")})
    return project.sidecar(rows, "page_id", "url", "rating", ["host", "section", "none"])


@query("""SELECT p_partkey || '.json' AS file_name, array_to_string(list_concat([replace(p_type, '_', ' ')],
 list_filter(string_split_regex(p_name, '\\s+'), lambda x: x <> '')), ', ') AS tags, '' AS caption FROM part""")
def training_projection(spark, sf_dir):
    name = F.concat(F.col("p_partkey").cast("string"), F.lit(".json"))
    return read(spark, sf_dir, "part").select(*project.training_record(name, F.col("p_type"), F.col("p_name")))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(text), '[,\\s]+'), lambda x: x <> ''))), ' ') AS tokens FROM documents")
def token_set(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", tags.sorted_tokens(tags.token_set(F.col("text"))).alias("tokens"))


@query("""SELECT p_partkey AS id, lower(p_name) AS tags, p_size::BIGINT AS score FROM part
 UNION ALL SELECT doc_id, lower(source), n_chars FROM documents""")
def union_relaxed(spark, sf_dir):
    a = ColumnBinding("p_partkey", "p_name", score="p_size").canonical(read(spark, sf_dir, "part"))
    docs = read(spark, sf_dir, "documents").withColumn("score", F.col("n_chars").cast("string"))
    return a.unionByName(ColumnBinding("doc_id", "source").canonical(docs)).select("id", "tags", "score")


@query("SELECT doc_id AS id, lower(source) AS tags, lower(lang) AS rating, n_chars AS score FROM documents")
def column_binding(spark, sf_dir):
    return ColumnBinding("doc_id", "source", rating="lang", score="n_chars").canonical(read(spark, sf_dir, "documents")).select("id", "tags", "rating", "score")


def _index(spark, sf_dir) -> DataFrame:
    rank = F.col("l_linenumber").cast("int")
    name = F.format_string("a%04d.tar", F.col("l_suppkey") % 50)
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id"), name.alias("archive"), F.concat(F.col("l_partkey").cast("string"), F.lit(".jpg")).alias("inner_path"), rank.alias("archive_rank"))


_I = "(SELECT l_orderkey AS image_id, printf('a%04d.tar', l_suppkey % 50) AS archive, l_partkey || '.jpg' AS inner_path, l_linenumber AS archive_rank FROM lineitem)"
_L = f"(SELECT image_id, archive, inner_path FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY archive_rank DESC, archive DESC, inner_path DESC) AS rn FROM {_I}) WHERE rn = 1)"


def _resolved(spark, sf_dir) -> DataFrame:
    items = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("").alias("url"))
    return archive.resolve(items, _index(spark, sf_dir))


@query(f"SELECT o_orderkey AS id, archive, inner_path FROM orders LEFT JOIN {_L} ON o_orderkey = image_id")
def archive_join(spark, sf_dir):
    return _resolved(spark, sf_dir).select("id", "archive", "inner_path")


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'x' || page_id % 7 || '.tar' END AS archive,
 CASE WHEN page_id % 2 = 0 THEN 'in/' || page_id || '.png' END AS inner_path FROM pages""")
def archive_fallback_url(spark, sf_dir):
    i = F.col("page_id")
    url = F.when(i % 2 == 0, F.concat(F.lit("http://h/x"), (i % 7).cast("string"), F.lit(".tar/in/"), i.cast("string"), F.lit(".png"))).otherwise(F.col("url"))
    found, inner = values.archive_in_url(url)
    return read(spark, sf_dir, "pages").select("page_id", found.alias("archive"), inner.alias("inner_path"))


@query(f"SELECT archive, count(*) AS n_items FROM orders JOIN {_L} ON o_orderkey = image_id GROUP BY archive")
def archive_group_counts(spark, sf_dir):
    return archive.group_counts(_resolved(spark, sf_dir))


_WANTED = "CASE page_id % 5 WHEN 0 THEN 'd/' || page_id || '.png' WHEN 1 THEN 'd/n' || page_id || '.bmp' WHEN 2 THEN 'zz' WHEN 3 THEN 'd/n' || page_id || '.bmp' END"
_MEMBER = "CASE page_id % 5 WHEN 0 THEN 'd/' || page_id || '.png' WHEN 1 THEN 'd/n' || page_id || '.jpg' WHEN 2 THEN page_id || '.webp' ELSE 'n' || page_id || '.jpg' END"


@query(f"""WITH w AS (SELECT page_id AS id, 't' || page_id % 5 || '.tar' AS archive, coalesce({_WANTED}, page_id || '.jpg') AS ip FROM pages),
 m AS (SELECT 't' || page_id % 5 || '.tar' AS archive, {_MEMBER} AS member, page_id AS pos FROM pages WHERE page_id % 5 <> 4
 UNION ALL SELECT 't4.tar', 'x' || page_id || '.png', page_id FROM pages WHERE page_id % 10 = 3),
 x AS (SELECT unnest(['.jpg', '.jpeg', '.png', '.webp', '.gif']) AS ext, unnest([0, 1, 2, 3, 4]) AS e),
 tries AS (SELECT id, archive, ip AS member, 1 AS r, 0 AS e FROM w
 UNION ALL SELECT id, archive, regexp_replace(ip, '\\.[a-z]+$', '') || ext, 2, e FROM w, x UNION ALL SELECT id, archive, id || ext, 3, e FROM w, x),
 hits AS (SELECT t.id, t.archive, m.member, t.r, t.e, m.pos FROM tries t JOIN m ON t.archive = m.archive AND t.member = m.member
 UNION ALL SELECT w.id, w.archive, m.member, 4, 0, m.pos FROM w JOIN m ON w.archive = m.archive AND contains(m.member, w.id::VARCHAR))
 SELECT id, archive, member, r AS strategy FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r, e, pos) AS k FROM hits) WHERE k = 1""")
def member_priority_match(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    place = F.concat(F.lit("t"), (F.col("page_id") % 5).cast("string"), F.lit(".tar"))
    wanted = pages.select(F.col("page_id").alias("id"), place.alias("archive"), F.expr(_WANTED).alias("inner_path"))
    members = pages.where("page_id % 5 <> 4").select(place.alias("archive"), F.expr(_MEMBER).alias("member"), F.col("page_id").alias("pos"))
    more = pages.where("page_id % 10 = 3").select(F.lit("t4.tar").alias("archive"), F.concat(F.lit("x"), F.col("page_id").cast("string"), F.lit(".png")).alias("member"), F.col("page_id").alias("pos"))
    return archive.match_members(wanted, members.unionByName(more))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti(spark, sf_dir):
    return reconcile.pending(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), read(spark, sf_dir, "labels"), "doc_id")


_DONE, _DISK, _MISS = "(SELECT doc_id FROM labels WHERE quality = 1)", "(SELECT doc_id FROM labels WHERE toxic = 0)", "(SELECT doc_id FROM documents WHERE doc_id % 10 = 3 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1))"


@query(f"SELECT doc_id FROM documents WHERE doc_id NOT IN {_DONE} AND doc_id IN {_DISK}")
def adopt_semi(spark, sf_dir):
    lab = read(spark, sf_dir, "labels")
    return reconcile.adopt(read(spark, sf_dir, "documents").select("doc_id"), lab.where("toxic = 0"), lab.where("quality = 1"), "doc_id")


@query(f"""SELECT doc_id, CASE WHEN c AND d THEN 'verified' WHEN c THEN 'missing' WHEN m AND d THEN 'recovered' WHEN m THEN 'still_missing' ELSE 'untracked' END AS state
 FROM (SELECT doc_id, doc_id IN {_DONE} AS c, doc_id IN {_MISS} AS m, doc_id IN {_DISK} AS d FROM documents) WHERE c OR m OR d""")
def reconcile_status(spark, sf_dir):
    lab, docs = read(spark, sf_dir, "labels"), read(spark, sf_dir, "documents")
    done = lab.where("quality = 1")
    missing = docs.where("doc_id % 10 = 3").join(done, "doc_id", "left_anti")
    return reconcile.reconcile(done, missing, lab.where("toxic = 0"), "doc_id")


def _pairs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    part = read(spark, sf_dir, "part").select(F.col("p_brand").alias("dir"), F.col("p_partkey").alias("stem"), F.col("p_size"))
    return part.where("stem % 3 <> 0"), part.where("stem % 4 <> 0")


@query("SELECT p_brand AS dir, p_partkey AS stem FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 4 = 0")
def orphans_image(spark, sf_dir):
    a, b = _pairs(spark, sf_dir)
    return reconcile.orphans(a, b, ["dir", "stem"]).select("dir", "stem")


@query("SELECT p_brand AS dir, p_partkey AS stem FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 3 = 0")
def orphans_json(spark, sf_dir):
    a, b = _pairs(spark, sf_dir)
    return reconcile.orphans(b, a, ["dir", "stem"]).select("dir", "stem")


_CLASS = "CASE WHEN p_partkey % 3 = 0 THEN 'orphan_json' WHEN p_partkey % 4 = 0 THEN 'orphan_image' WHEN p_size > 5 THEN 'valid' ELSE 'corrupt' END"


@query(f"SELECT p_partkey AS id, {_CLASS} AS class FROM part WHERE p_partkey % 12 <> 0")
def pair_classes(spark, sf_dir):
    a, b = _pairs(spark, sf_dir)
    return reconcile.pair_classes(a.select(F.col("stem").alias("id"), (F.col("p_size") > 5).alias("valid")), b.select(F.col("stem").alias("id")))


@query(f"""SELECT shard, count(*) AS files, sum(size)::BIGINT AS bytes, count(*) FILTER (class = 'valid') AS valid, count(*) FILTER (class = 'corrupt') AS corrupt,
 count(*) FILTER (class = 'orphan_image') AS orphan_image, count(*) FILTER (class = 'orphan_json') AS orphan_json, 0::BIGINT AS unknown,
 count(*) FILTER (class <> 'valid') AS total_issues FROM (SELECT p_brand AS shard, p_size::BIGINT AS size, {_CLASS} AS class FROM part) GROUP BY ROLLUP (shard)""")
def audit_by_shard(spark, sf_dir):
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, "orphan_json").when(k % 4 == 0, "orphan_image").when(F.col("p_size") > 5, "valid").otherwise("corrupt")
    return audit.by_shard(read(spark, sf_dir, "part").select(F.col("p_brand").alias("shard"), F.col("p_size").cast("bigint").alias("size"), kind.alias("class")))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN p_size < 20 THEN 'too_small_' || p_size || 'bytes' WHEN p_partkey % 7 = 0 THEN 'unidentified'
 WHEN p_size < 30 THEN 'dimensions_' || p_size || 'x40' END AS reason FROM part) WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason LIMIT 10""")
def corruption_top10(spark, sf_dir):
    s = F.col("p_size")
    error = F.when(F.col("p_partkey") % 7 == 0, "unidentified")
    rows = read(spark, sf_dir, "part").select(audit.invalid_reason(s, s, F.lit(40), error, 20, 30).alias("reason"))
    return audit.top_reasons(rows)


@query("SELECT id, printf('shard_%05d', id // 5000) AS shard FROM (SELECT o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 9007199254740993 ELSE 0 END AS id FROM orders)")
def shard_by_id(spark, sf_dir):
    """Ids above 2**53 are among them."""
    big = F.when(F.col("o_orderkey") % 3 == 0, F.lit(9007199254740993)).otherwise(F.lit(0))
    return shards.by_id(read(spark, sf_dir, "orders").select((F.col("o_orderkey") + big).alias("id")), 5000)


_ASSIGNED = "(SELECT id, CASE WHEN id % 10 = 0 THEN id // 2000 ELSE 3 + floor((rank + 700) / 1000)::BIGINT END AS shard FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 0 THEN row_number() OVER (PARTITION BY o_orderkey % 10 <> 0 ORDER BY o_orderkey) - 1 END AS rank FROM orders))"


def _assigned(spark, sf_dir) -> DataFrame:
    ids = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    known = ids.where("id % 10 = 0").withColumn("shard", F.floor(F.col("id") / 2000))
    return shards.by_count(ids, known, 1000, 3, 700)


@query(f"SELECT id, shard FROM {_ASSIGNED}")
def shard_by_count(spark, sf_dir):
    return _assigned(spark, sf_dir)


@query(f"SELECT count(*) AS n_shards, sum(n)::BIGINT AS n_files, min(n) AS min_files, max(n) AS max_files, avg(n) AS avg_files FROM (SELECT shard, count(*) AS n FROM {_ASSIGNED} GROUP BY shard)")
def shard_fill_stats(spark, sf_dir):
    return shards.fill_statistics(_assigned(spark, sf_dir))


@query(f"""WITH i AS (SELECT id, width * 2 AS w, height * 2 AS h, least(width, height) * 2 AS side, greatest(width, height) * 2 AS long FROM {_P}),
 s AS (SELECT *, greatest(1, floor(side * (1 - 0.18::DOUBLE)))::INTEGER AS step FROM i),
 n AS (SELECT *, greatest(1, ceil((long - side) / step))::INTEGER AS n, long < side * 1.3::DOUBLE AS one FROM s),
 c AS (SELECT *, unnest(generate_series(0, CASE WHEN one THEN 0 ELSE n - 1 END)) AS k FROM n),
 o AS (SELECT *, least(long - side, k * step) AS off FROM c)
 SELECT id, (k + 1)::INTEGER AS crop, (CASE WHEN one THEN (w - side) // 2 WHEN w >= h THEN off ELSE 0 END)::INTEGER AS x,
 (CASE WHEN one THEN (h - side) // 2 WHEN w >= h THEN 0 ELSE off END)::INTEGER AS y, side::INTEGER AS side FROM o""")
def crop_rois(spark, sf_dir):
    rows = _sized(spark, sf_dir).select("id", (F.col("width") * 2).alias("w"), (F.col("height") * 2).alias("h"))
    return geometry.explode_crops(rows).select("id", "crop", "x", "y", "side")


@query(f"SELECT id FROM {_P} WHERE NOT (width = height AND width >= 1024) AND least(width, height) >= 1024")
def crop_eligibility(spark, sf_dir):
    return _sized(spark, sf_dir).where(geometry.crop_eligible(F.col("width"), F.col("height"))).select("id")


@query("SELECT p_partkey::VARCHAR AS stem, '.png' AS ext FROM part WHERE p_partkey % 3 = 1")
def crop_done_semi(spark, sf_dir):
    stem = F.col("p_partkey").cast("string")
    part = read(spark, sf_dir, "part")
    crops = part.where("p_partkey % 3 = 1").select(F.concat(stem, F.lit("_1.png")).alias("name"))
    return geometry.originals_with_crop(part.select(stem.alias("stem"), F.lit(".png").alias("ext")), crops)


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'none' WHEN p_partkey % 4 = 1 THEN 'delete' WHEN p_size % 6 = 0 OR p_size <> p_partkey % 50 THEN 'move' ELSE 'none' END AS action FROM part""")
def file_action(spark, sf_dir):
    k = F.col("p_partkey")
    ext = F.when(k % 5 == 0, ".txt").otherwise(".PNG")
    error = F.when(F.col("p_size") % 6 == 0, "truncated")
    files = read(spark, sf_dir, "part").select(k.alias("id"), k.cast("string").alias("name"), ext.alias("ext"), error.alias("error"), F.col("p_size").alias("w"), (k % 50).cast("int").alias("h"))
    return audit.file_action(files, files.where("id % 4 = 1")).select("id", "action")


@query("""SELECT p_brand AS dir, p_partkey || '.png' AS old_name, p_partkey || '_x.png' AS new_name, p_partkey || '.json' AS json_name, p_partkey || '_x.json' AS new_json_name
 FROM part WHERE p_partkey % 4 <> 0""")
def rename_plan(spark, sf_dir):
    stem = F.col("p_partkey").cast("string")
    has = F.when(F.col("p_partkey") % 4 != 0, F.concat(stem, F.lit(".json")))
    files = read(spark, sf_dir, "part").select(F.col("p_brand").alias("dir"), stem.alias("stem"), F.lit(".png").alias("ext"), has.alias("json_name"))
    return project.rename_plan(files, "_x")


_TOK = "list_filter(string_split_regex(lower({}), '[,\\s]+'), lambda x: x <> '')"


@query(f"""WITH a AS (SELECT lower(source || '/' || doc_id % 100) AS f, list_sort(list_distinct(flatten(list({_TOK.format('text')})))) AS t FROM documents WHERE doc_id % 3 <> 0 GROUP BY 1),
 b AS (SELECT lower(source || '/' || doc_id % 100) AS f, list_distinct(flatten(list({_TOK.format('text')}))) AS t FROM documents WHERE doc_id % 3 <> 1 GROUP BY 1),
 a2 AS (SELECT split_part(f, '/', 2) AS f, list_sort(list_distinct(flatten(list(t)))) AS t FROM a GROUP BY 1), b2 AS (SELECT split_part(f, '/', 2) AS f, list_distinct(flatten(list(t))) AS t FROM b GROUP BY 1)
 SELECT coalesce(a2.f, b2.f) AS file_name, array_to_string(coalesce(a2.t, []), ' ') AS original_tags,
 array_to_string(list_sort(list_filter(coalesce(b2.t, []), lambda x: NOT list_contains(coalesce(a2.t, []), x))), ' ') AS added,
 array_to_string(list_sort(list_filter(coalesce(a2.t, []), lambda x: NOT list_contains(coalesce(b2.t, []), x))), ' ') AS removed
 FROM a2 FULL JOIN b2 ON a2.f = b2.f""")
def tag_delta(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 100).cast("string").alias("file_name"), F.col("text").alias("tags"))
    return delta.tag_delta(docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 <> 1"), "doc_id")


@query("SELECT event_id FROM events WHERE lower(trim(event_type)) = 'click'")
def json_keyword(spark, sf_dir):
    text = F.to_json(F.struct(F.struct(F.array(F.col("event_type")).alias("kinds")).alias("inner"), F.col("value").alias("click")))
    return read(spark, sf_dir, "events").where(jsonops.contains_keyword(text, " Click ")).select("event_id")


@query("SELECT event_id, 0 AS item, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_flatten(spark, sf_dir):
    return jsonops.flatten_objects(read(spark, sf_dir, "events").select("event_id", "props"), "props")


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN page_id WHEN 1 THEN 10000 + page_id END AS by_name, CASE page_id % 3 WHEN 0 THEN page_id END AS by_key FROM pages""")
def id_from_name(spark, sf_dir):
    i = F.col("page_id")
    path = F.when(i % 3 == 0, F.concat(F.lit("a/b/"), i.cast("string"), F.lit(".x.jpg"))).when(i % 3 == 1, F.concat(F.lit("p_"), (i + 10000).cast("string"), F.lit("_12.jpg"))).otherwise("none.jpg")
    name = F.when(i % 3 == 0, F.concat(F.lit("a/b/"), i.cast("string"), F.lit(".jpg"))).otherwise(path)
    return read(spark, sf_dir, "pages").select("page_id", values.id_from_name(name).alias("by_name"), values.id_from_key(path).alias("by_key"))


@query("SELECT page_id, strlen(html) >= 100 AND page_id % 3 <> 0 AS ok FROM pages")
def md5_verify(spark, sf_dir):
    claimed = F.when(F.col("page_id") % 3 == 0, F.lit("0")).otherwise(F.upper(F.md5("html")))
    return read(spark, sf_dir, "pages").select("page_id", audit.payload_ok(F.encode("html", "UTF-8"), claimed).alias("ok"))

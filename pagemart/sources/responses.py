"""Landed page responses -> staging tables.

A landed response is one row per fetch: ``(source, source_rank, list_pos, page_id, chunk,
status, body)`` where ``body`` is the API's JSON text ``{success, data: {page, insights,
posts}}`` and ``chunk`` numbers the pages of a paginated answer (0 when there is one).

Rules (as the loader applies them):
- accept: HTTP 200, body is a JSON object whose ``success`` is truthy in the Python sense
  (``false``, ``0``, ``""``, ``{}``, ``[]``, ``null`` are not);
- ``data.page`` (an object) and ``data.insights`` (an array) are required, ``data.posts`` defaults
  to ``[]``;
- every record writes only the keys it carries (absent keeps the stored value, an explicit
  null overwrites), last record per id wins: managed list before unmanaged list, then list
  position, page chunk and position in the array;
- a page that fails any rule is rejected as a whole (the loader could leave half a page
  behind; here nothing of it is written) and reported with a reason. The unit is one landed
  response: when an answer is paginated, each of its responses is accepted or rejected on its
  own (with one response per page, as the loader fetches, that is the page).

Validation runs inside each response row with array functions: no shuffle is needed to reject
a page. The body is parsed once (to a VARIANT) and each value is cast once. With
``spark.sql.variant.allowDuplicateKeys`` on (the session default here) a repeated key keeps
its last value, as a Python JSON load does; with it off such a body is rejected as not JSON.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import JSON_OPTIONS
from ..operators.upsert import only_records, repeated_keys, upsert_partial
from ..schemas import STG_CLIENT_COLUMNS, STG_INSIGHT_COLUMNS, STG_POST_COLUMNS
from ..storage import remove, written_at

# The JSON parser takes strings up to 20M characters and values up to 128 MB. A larger body may be sound; it has to be
# landed record by record (``ingest_records``).
ONE_VALUE_BYTES = 20_000_000
SEQ = ["source_rank", "list_pos", "chunk", "array_pos"]
ZONE_SUFFIX = r"(Z|[+-]\d{2}(:?\d{2})?)$"
ZONE_SUFFIX_SQL = ZONE_SUFFIX.replace("\\", "\\\\")  # as a SQL string literal


def json_truthy_sql(v: str) -> str:
    """SQL: Python truthiness of a VARIANT value (a scalar here, so its schema is cheap):
    NULL/absent, false, 0, "", {} and [] are false."""
    t = f"schema_of_variant({v})"
    return f"""coalesce(CASE
        WHEN {t} IS NULL OR {t} = 'VOID' THEN false
        WHEN {t} = 'BOOLEAN' THEN try_variant_get({v}, '$', 'boolean')
        WHEN {t} = 'STRING' THEN length(try_variant_get({v}, '$', 'string')) > 0
        WHEN startswith({t}, 'OBJECT') THEN {t} <> 'OBJECT<>'
        WHEN startswith({t}, 'ARRAY') THEN json_array_length(to_json({v})) > 0
        ELSE try_variant_get({v}, '$', 'double') <> 0 END, true)"""


_SQL_TYPE = {"int": "INT", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP_NTZ", "date": "DATE"}


def _from_text_sql(x: str, typ: str) -> str:
    """SQL for storing a JSON value given as text ``x`` into a column of type ``typ`` the way
    the database coerces a bound value: integers from integral or numeric text (rounded),
    timestamps without zone (a zone suffix is ignored), text as is minus NUL characters."""
    if typ in ("int", "bigint"):
        t = _SQL_TYPE[typ]
        return f"coalesce(try_cast({x} AS {t}), try_cast(round(try_cast({x} AS DECIMAL(38,9))) AS {t}))"
    if typ == "timestamp_ntz":
        return (f"coalesce(try_cast({x} AS TIMESTAMP_NTZ), "
                f"try_cast(regexp_replace({x}, '{ZONE_SUFFIX_SQL}', '') AS TIMESTAMP_NTZ))")
    if typ == "date":
        return f"try_cast({x} AS DATE)"
    return f"replace({x}, char(0), '')"


# The record expressions below are written as SQL text and turned into one Column each: built
# node by node from Python they would cost thousands of driver round trips per plan.

def typed_columns_sql(r: str, cols: list[tuple[str, str]]) -> list[str]:
    """``present`` (the keys it carries) and the staging columns of one record given as a map of texts ``r``.

    The lambda behind ``present`` keeps this projection out of whole-stage code: as one method, the columns would be too large for
    the JIT and run ten times slower; outside, Spark splits them into methods."""
    return [f"filter(map_keys({r}), k -> k IS NOT NULL) AS present",
            *(f"{_from_text_sql(f'{r}[{n!r}]', t)} AS `{n}`" for n, t in cols)]


def _suspicious_sql(m: str, cols: list[tuple[str, str]]) -> str:
    """Whether any entry of the record's map is of an unknown column or a value its column cannot hold. It looks at the entries
    there are, not at every column there could be."""
    of: dict[str, list[str]] = {}
    for n, t in cols:
        of.setdefault(t, []).append(f"'{n}'")
    texts = ", ".join(of.pop("string"))
    others = ", ".join(n for names in of.values() for n in names)
    tests = " ".join(f"WHEN k IN ({', '.join(names)}) THEN ({_from_text_sql('v', t)}) IS NULL" for t, names in of.items())
    return (f"size(map_filter({m}, (k, v) -> CASE WHEN k IN ({texts}) THEN false "
            f"WHEN v IS NULL THEN k NOT IN ({others}) {tests} ELSE true END)) > 0")


def record_problem_sql(m: str, cols: list[tuple[str, str]]) -> str:
    """First problem of a record given as a map of texts: not an object, unknown column, no id, a value the column type cannot
    hold; NULL when the record is fine. ``m`` must be an already computed value (a column or a lambda variable): inside
    array lambdas Spark does not share repeated sub-expressions."""
    names = ", ".join(f"'{n}'" for n, _ in cols)
    wrong = " ".join(f"WHEN {m}['{n}'] IS NOT NULL AND ({_from_text_sql(f'{m}[{n!r}]', t)}) IS NULL THEN '{n}'" for n, t in cols
                     if t != "string")
    unknown = f"array_except(map_keys({m}), array({names}))"
    return (f"CASE WHEN {m} IS NULL THEN 'record is not a JSON object' "
            f"WHEN {m}['id'] IS NOT NULL AND NOT ({_suspicious_sql(m, cols)}) THEN NULL "
            f"WHEN size({unknown}) > 0 THEN concat('unknown column: ', array_join({unknown}, ',')) "
            f"WHEN {m}['id'] IS NULL THEN 'record without id' "
            f"ELSE concat('bad value for ', CASE {wrong} END) END")


def _first_problem_sql(arr: str, cols) -> str:
    return f"try_element_at(filter(transform({arr}, p -> {record_problem_sql('p', cols)}), b -> b IS NOT NULL), 1)"


RECORD = "map<string,string>"     # a record: its keys and their values as text (an object or array as its JSON text)


def check_responses(landed: DataFrame) -> DataFrame:
    """Landed rows plus ``page``, ``insights``, ``posts`` (records as maps of texts) and ``reason``
    (NULL when the page is accepted). The body is parsed once, into a VARIANT, and every record is taken out of
    that binary value once; the checks read the maps."""
    with_v = landed.withColumn("__v", F.try_parse_json("body"))
    # Structure tests use typed extraction (NULL when the shape is wrong) instead of
    # schema_of_variant, which would describe every nested record of the body; what can be large is extracted once.
    parts = with_v.select(
        *landed.columns,
        F.expr(f"try_variant_get(__v, '$.data.page', '{RECORD}')").alias("page"),
        F.expr(f"try_variant_get(__v, '$.data.insights', 'array<{RECORD}>')").alias("insights"),
        F.expr(f"try_variant_get(__v, '$.data.posts', 'array<{RECORD}>')").alias("posts"),
        F.expr(f"""CASE
            WHEN status <> 200 THEN concat('http status ', CAST(status AS STRING))
            WHEN __v IS NULL AND octet_length(body) > {ONE_VALUE_BYTES} THEN 'body is not JSON, or too large to parse as one value'
            WHEN __v IS NULL THEN 'body is not JSON'
            WHEN NOT {json_truthy_sql("try_variant_get(__v, '$.success', 'variant')")} THEN 'success is false or missing'
            WHEN try_variant_get(__v, '$.data.page', 'variant') IS NULL
              OR is_variant_null(try_variant_get(__v, '$.data.page', 'variant')) THEN 'no data.page'
            END""").alias("__envelope"),
        # the keys alone: whether there are posts at all, of whatever shape
        F.expr("coalesce(array_contains(map_keys(try_variant_get(__v, '$.data', 'map<string,boolean>')), 'posts'), false)").alias("__has_posts"),
    )
    reason = F.expr(f"""coalesce(__envelope,
        CASE WHEN insights IS NULL THEN 'no insights array' WHEN posts IS NULL AND __has_posts THEN 'posts is not an array' END,
        concat('page: ', {record_problem_sql('page', STG_CLIENT_COLUMNS)}),
        concat('insight: ', {_first_problem_sql('insights', STG_INSIGHT_COLUMNS)}),
        concat('post: ', {_first_problem_sql('posts', STG_POST_COLUMNS)}))""")
    return parts.withColumn("reason", reason).drop("__envelope", "__has_posts")


# For a table that is soon read whole and removed: looking every key and value of the records up in dictionaries, and keeping their least
# and greatest, is a third of the time of writing them.
READ_ONCE = {"parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false"}


class RejectedTooMany(RuntimeError):
    """More pages were rejected than a run accepts."""


class Staged:
    """Staging tables after one ingest, plus the rejected pages. Each table is planned on
    first access, so a caller that needs one table does not build the others."""

    _path: str | None = None
    by_id = False       # whether ids stand apart from the records (``materialize``)

    def __init__(self, checked: DataFrame, targets: dict[str, DataFrame], track_order: bool = False):
        self.checked, self.targets, self.track_order = checked, targets, track_order
        self._scratch: list[str] = []

    @cached_property
    def _pages(self) -> DataFrame:
        return _records(self.checked, "page", STG_CLIENT_COLUMNS, many=False)

    @cached_property
    def clients(self) -> DataFrame:
        return self._staged("stg_clients", "page", STG_CLIENT_COLUMNS, lambda: self._pages.where(F.col("source") == "managed"), "managed")

    @cached_property
    def unmanaged_clients(self) -> DataFrame:
        return self._staged("stg_unmanaged_clients", "page", STG_CLIENT_COLUMNS, lambda: self._pages.where(F.col("source") == "unmanaged"), "unmanaged")

    @cached_property
    def insights(self) -> DataFrame:
        return self._staged("stg_insights", "insights", STG_INSIGHT_COLUMNS, lambda: _records(self.checked, "insights", STG_INSIGHT_COLUMNS))

    @cached_property
    def posts(self) -> DataFrame:
        return self._staged("stg_posts", "posts", STG_POST_COLUMNS, lambda: _records(self.checked, "posts", STG_POST_COLUMNS))

    def _staged(self, table: str, field: str, cols, records: Callable[[], DataFrame], source: str | None = None) -> DataFrame:
        target = self.targets.get(table)
        if not self.by_id or target is not None or not self.track_order:
            return _stage(records(), cols, target, self.track_order)
        pages = self.checked if source is None else self.checked.where(F.col("source") == source)
        ids = F.explode(F.when(F.col("reason").isNull(), F.col(_ids(field)))).alias("id")
        repeated, path = repeated_keys(pages.select(ids), "id")
        self._scratch.append(path)
        keys = F.explode(F.when(F.col("reason").isNull(), F.col(_keys(field)))).alias("key")
        found = {r.key for r in pages.select(keys).distinct().collect()} | {"id"}      # accepted records have no other keys than columns
        held = [(n, t) for n, t in cols if n in found] if len(found) > 1 else cols
        only, several = (_records(pages, field, held, field != "page", (repeated, how)) for how in ("left_anti", "left_semi"))
        rows = (only_records(only, ["id"], SEQ, "present", [n for n, _ in held if n != "id"], ORDER)
                .unionByName(_stage(several, held, None, True)))
        return rows.select(*[F.col(n) if (n, t) in held else F.lit(None).cast(t).alias(n) for n, t in cols], ORDER)

    @cached_property
    def rejects(self) -> DataFrame:
        return rejected(self.checked)

    def materialize(self) -> "Staged":
        """Validate once for all outputs: a job that writes every staging table (and the
        rejects) would otherwise re-run the whole validation per table. Keeps only what the
        outputs read (the records and the reason, not the body) and writes it under
        ``spark.checkpoint.dir``, which also cuts the lineage back to the landed files; each output then reads its own columns only.
        The ids and the keys of the records stand in columns of their own: which ids more than one record has, and which columns any
        record holds, is found without the records."""
        parts = [("page", "array(page)", STG_CLIENT_COLUMNS), ("insights", "insights", STG_INSIGHT_COLUMNS), ("posts", "posts", STG_POST_COLUMNS)]
        ids = [F.expr(f"transform({arr}, r -> {_id_sql(cols)})").alias(_ids(field)) for field, arr, cols in parts]
        keys = [F.expr(f"array_distinct(flatten(transform({arr}, r -> map_keys(r))))").alias(_keys(field)) for field, arr, _ in parts]
        self.checked, self._path = written_at(self.checked.drop("body").select("*", *ids, *keys), "staged", **READ_ONCE)
        self.by_id = True
        for name in ("_pages", "clients", "unmanaged_clients", "insights", "posts", "rejects"):
            self.__dict__.pop(name, None)
        return self

    def release(self) -> None:
        """Remove what ``materialize`` wrote; the outputs cannot be read any more."""
        if self._path is not None:
            for path in (self._path, *self._scratch):
                remove(self.checked.sparkSession, path)
            self._path, self._scratch = None, []

    def reject_ratio(self) -> float:
        """Share of landed responses rejected (one aggregation, two numbers to the driver)."""
        row = self.checked.agg(F.count(F.lit(1)).alias("n"),
                               F.count(F.col("reason")).alias("bad")).first()
        return (row["bad"] / row["n"]) if row["n"] else 0.0

    def check_rejects(self, max_ratio: float | None) -> None:
        """Fail the run when more than ``max_ratio`` of the responses were rejected (the load
        would otherwise "succeed" with little or nothing staged)."""
        if max_ratio is None:
            return
        ratio = self.reject_ratio()
        if ratio > max_ratio:
            raise RejectedTooMany(f"{ratio:.1%} of the landed responses were rejected (limit {max_ratio:.1%})")

    def tables(self) -> dict[str, DataFrame]:
        return {"stg_clients": self.clients, "stg_unmanaged_clients": self.unmanaged_clients,
                "stg_insights": self.insights, "stg_posts": self.posts}


def _records(checked: DataFrame, field: str, cols: list[tuple[str, str]], many: bool = True, of: tuple[DataFrame, str] | None = None) -> DataFrame:
    """Records of accepted pages only. The accept test sits *inside* the generator
    (``explode(when(reason IS NULL, records))``) rather than in a filter: Catalyst would push a
    filter on ``reason`` below the projection that computes it and evaluate the whole
    validation twice; it never pushes a predicate through a generator. ``of``: ids, and the kind of join with them that tells which
    records are typed at all."""
    base = ["source", "source_rank", "list_pos", "chunk"]
    ok = F.col("reason").isNull()
    arr = F.col(field) if many else F.array(F.col(field))
    rows = checked.select(*base, F.posexplode(F.when(ok, arr)).alias("array_pos", "r"))
    if of is not None:
        ids, how = of
        # accepted records have ids; said on both sides, a shuffle for the join is made once for the two kinds
        rows = rows.withColumn("id", F.expr(_id_sql(cols))).where("id IS NOT NULL").join(ids, "id", how).drop("id")
    pos = F.col("array_pos").cast("int") if many else F.lit(-1)
    return rows.select(*base, pos.alias("array_pos"), *map(F.expr, typed_columns_sql("r", cols)))


def _ids(field: str) -> str:
    return f"__{field}_ids"


def _keys(field: str) -> str:
    return f"__{field}_keys"


def _id_sql(cols: list[tuple[str, str]]) -> str:
    return _from_text_sql("r['id']", dict(cols)["id"])


ORDER = "__order"   # per stored row: which record each column's value comes from


def _stage(records: DataFrame, cols, target: DataFrame | None, track_order: bool = False) -> DataFrame:
    names = [n for n, _ in cols]
    known = [ORDER] if target is not None and ORDER in target.columns else []
    out = upsert_partial(records, ["id"], SEQ, "present", [n for n in names if n != "id"],
                         target.select(*names, *known) if target is not None else None, ORDER if track_order else None)
    return out.select(*names, *([ORDER] if track_order else []))


def rejected(checked: DataFrame) -> DataFrame:
    """Rejected pages with their reason (the test sits in a generator, see ``_records``)."""
    keep = ["source", "list_pos", "page_id", "chunk", "status"]
    return checked.select(*keep, F.explode(F.when(F.col("reason").isNotNull(), F.array("reason"))).alias("reason"))


def ingest(landed: DataFrame, targets: dict[str, DataFrame] | None = None,
           max_reject_ratio: float | None = None, track_order: bool = False) -> Staged:
    """Stage all accepted pages of ``landed`` (upserted into ``targets`` when given, keyed by
    table name ``stg_clients`` / ``stg_unmanaged_clients`` / ``stg_insights`` / ``stg_posts``;
    the default is a full refresh, as the run truncates staging first). With
    ``max_reject_ratio`` the run fails (``RejectedTooMany``) when a larger share of the
    responses is rejected; that check is one extra validation pass, so a job that writes the
    rejects anyway should count them there instead (as ``streaming.ingest.stage_batch`` does).
    ``track_order`` adds the column ``__order``: targets that have it are merged by record order,
    whatever batch a record came in."""
    staged = Staged(check_responses(landed), targets or {}, track_order)
    staged.check_rejects(max_reject_ratio)
    return staged


PAGE_KEY = ["source", "source_rank", "list_pos", "page_id", "chunk"]
PARTS = {"insight": STG_INSIGHT_COLUMNS, "post": STG_POST_COLUMNS}


def _parsed_parts(rows: DataFrame, part: str, cols: list[tuple[str, str]]) -> DataFrame:
    """Records of one part (maps of texts) with their first problem. The text is parsed to a map of texts, so a
    record's strings may have any length a row can hold."""
    parsed = (rows.where(F.col("part") == part)
              # a generator keeps the parse from being put into every use of its result
              .select(*PAGE_KEY, "array_pos", F.explode(F.array(F.from_json("body", RECORD, JSON_OPTIONS))).alias("r")))
    return parsed.withColumn("problem", F.expr(f"concat('{part}: ', {record_problem_sql('r', cols)})"))


class StagedRecords(Staged):
    """Staging tables from responses landed record by record."""

    def materialize(self) -> "StagedRecords":
        super().materialize()
        self.by_id = False      # a bad record elsewhere may reject a page
        return self

    def __init__(self, rows: DataFrame, targets: dict[str, DataFrame], track_order: bool = False):
        envelopes = rows.where("part = 'envelope'").drop("part", "array_pos")
        super().__init__(check_responses(envelopes), targets, track_order)
        self.parts = {k: _parsed_parts(rows, k, cols) for k, cols in PARTS.items()}
        self.all_pages = rows.select(*PAGE_KEY).distinct()

    @cached_property
    def bad_pages(self) -> DataFrame:
        """One row per rejected response: its first problem, the envelope's before the records'."""
        found = [self.checked.select(*PAGE_KEY, F.lit(0).alias("rank"), F.lit(-1).cast("bigint").alias("array_pos"), F.col("reason").alias("problem")),
                 self.all_pages.join(self.checked.select(*PAGE_KEY), PAGE_KEY, "left_anti").select(
                     *PAGE_KEY, F.lit(0).alias("rank"), F.lit(-1).cast("bigint").alias("array_pos"), F.lit("no envelope").alias("problem"))]
        found += [p.select(*PAGE_KEY, F.lit(i).alias("rank"), F.col("array_pos").cast("bigint").alias("array_pos"), "problem")
                  for i, p in enumerate(self.parts.values(), 1)]
        every = reduce(DataFrame.unionByName, found).where("problem IS NOT NULL")
        return every.groupBy(*PAGE_KEY).agg(F.min(F.struct("rank", "array_pos", "problem"))["problem"].alias("reason"))

    @cached_property
    def _pages(self) -> DataFrame:
        return _records(self.checked.join(self.bad_pages.select(*PAGE_KEY), PAGE_KEY, "left_anti"), "page", STG_CLIENT_COLUMNS, many=False)

    def _of(self, part: str) -> DataFrame:
        good = self.parts[part].join(self.bad_pages.select(*PAGE_KEY), PAGE_KEY, "left_anti")
        return good.select("source", "source_rank", "list_pos", "chunk", F.col("array_pos").cast("int").alias("array_pos"),
                           *map(F.expr, typed_columns_sql("r", PARTS[part])))

    @cached_property
    def insights(self) -> DataFrame:
        return _stage(self._of("insight"), STG_INSIGHT_COLUMNS, self.targets.get("stg_insights"), self.track_order)

    @cached_property
    def posts(self) -> DataFrame:
        return _stage(self._of("post"), STG_POST_COLUMNS, self.targets.get("stg_posts"), self.track_order)

    @cached_property
    def rejects(self) -> DataFrame:
        return self.bad_pages.select("source", "list_pos", "page_id", "chunk", "reason")


def ingest_records(rows: DataFrame, targets: dict[str, DataFrame] | None = None, track_order: bool = False) -> StagedRecords:
    """Stage responses landed one record per row, for responses too large to be one value.

    ``rows``: the columns of a landed response plus ``part`` and ``array_pos``. A response is one row with part 'envelope' (its
    JSON with empty arrays, status as received) and a row per record with part 'insight' or 'post', its place in the array and its JSON as
    body. Same rules and reasons as ``ingest``: one bad record rejects the whole response."""
    return StagedRecords(rows, targets or {}, track_order)

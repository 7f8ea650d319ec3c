"""One input, many outputs: splitting log records and routing change rows by configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BRANCHES = ("err", "start", "display", "action", "page")


def _flat(frame: DataFrame, struct: str) -> list[str]:
    return frame.schema[struct].dataType.fieldNames()


def _element_fields(frame: DataFrame, array: str) -> list[str]:
    return frame.schema[array].dataType.elementType.fieldNames()


def split_log(records: DataFrame, carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The five branches of parsed log records.

    err: the whole record, for every record with an error. The other branches do not show the error.
    start: records with a start object, and these feed no other branch. display / action: one row per
    array element with the page and common fields laid over it; a display takes the record's time, an
    action keeps its own. page: records with a page, without the arrays. ``carry`` names further
    top-level columns to keep in every branch.
    """
    other = records.where(F.col("start").isNull())
    return {
        "err": records.where(F.col("err").isNotNull()),
        "start": records.where(F.col("start").isNotNull()).select("common", "start", "ts", *carry),
        "display": _elements(other, "displays", carry, own_time=False),
        "action": _elements(other, "actions", carry, own_time=True),
        "page": other.where(F.col("page").isNotNull()).select("common", "page", "ts", *carry),
    }


def _laid_over(records: DataFrame, element: Column, inner: list[str], own_time: bool) -> list[Column]:
    """Fields of an array element with common and then page fields over it, and its time."""
    columns = []
    for name in dict.fromkeys([*inner, *_flat(records, "common"), *_flat(records, "page")]):
        if name == "ts":
            continue
        layers = [F.col(s)[name] for s in ("page", "common") if name in _flat(records, s)]
        columns.append(F.coalesce(*layers, *([element[name]] if name in inner else [])).alias(name))
    moment = element["ts"].try_cast("long") if own_time and "ts" in inner else F.col("ts")
    return [*columns, moment.alias("ts")]


def _elements(records: DataFrame, array: str, carry: tuple[str, ...], own_time: bool) -> DataFrame:
    exploded = records.select("common", "page", "ts", *carry, F.explode(array).alias("_e"))
    return exploded.select(*_laid_over(exploded, F.col("_e"), _element_fields(records, array), own_time), *carry)


def _over(under: Column, over: Column) -> Column:
    """Two maps as one; where both have a key, ``over`` wins. Each map is evaluated once, not for every key of the other."""
    return F.map_zip_with(under, over, lambda k, a, b: F.coalesce(b, a))


def _without(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda k, x: ~k.isin(*names))


def _whole_values(records: DataFrame, whole: str) -> tuple[DataFrame, dict[str, Column], tuple[Column, Column]]:
    """Values of the branches out of the records' own text: fields that no schema names stay in them."""
    members = "map<string,variant>"
    none = F.create_map().cast(members)

    def part(path: str, kind: str = members) -> Column:
        return F.try_variant_get("_v", path, kind)

    given = records.withColumn("_v", F.try_parse_json(whole))
    common, flag = F.coalesce(part("$.common"), none), F.col("common.is_new")
    # The flag may have been repaired after parsing; nothing else of a record is changed.
    repaired = F.when(flag.isNull(), common).otherwise(_over(common, F.create_map(F.lit("is_new"), flag.cast("variant"))))
    given = given.withColumn("_common", repaired)
    laid = F.create_map(F.lit("common"), F.parse_json(F.to_json("_common")))
    given = given.withColumn("_all", F.when(F.col("common").isNull(), part("$")).otherwise(_over(part("$"), laid)))

    def filled(fields: Column) -> Column:
        return F.map_filter(fields, lambda k, x: ~F.is_variant_null(x))

    around = _over(filled(F.col("_common")), filled(F.coalesce(part("$.page"), none)))
    given = given.withColumn("_around", _without(around, "ts"))
    given = given.withColumn("_moment", F.map_filter("_all", lambda k, x: k == "ts"))
    moment = F.col("_moment")
    single = {"err": F.col("_all"), "start": _without(F.col("_all"), "err"), "page": _without(F.col("_all"), "err", "displays", "actions")}
    displays = F.transform(part("$.displays", f"array<{members}>"), lambda e: _over(_over(e, F.col("_around")), moment))
    actions = F.transform(part("$.actions", f"array<{members}>"), lambda e: _over(e, F.col("_around")))
    return given, single, (displays, actions)


def split_messages(records: DataFrame, carry: tuple[str, ...] = (), whole: str | None = None) -> DataFrame:
    """All branches of :func:`split_log` as ``branch`` and JSON ``value``, in one pass.

    Every record is read and parsed once and gives its messages directly, where five separate
    branches would each read the input again. ``whole`` names a column with the record's own text:
    messages then hold all its fields, named by a schema or not, with the repaired flag laid over. Error messages are
    the whole record; start messages lack the error, page messages also both arrays; array elements keep their own
    fields, under those of common and page that are not null. Numbers come out in their shortest form.
    """
    in_start = F.col("start").isNotNull()
    columns = records.columns
    given, single, elements = records, None, None
    if whole is not None:
        given, single, elements = _whole_values(records, whole)

    def message(branch: str, when: Column, value: Column) -> Column:
        value = single[branch] if single else value
        return F.when(when, F.struct(F.lit(branch).alias("branch"), F.to_json(value).alias("value")))

    ones = F.array(
        message("err", F.col("err").isNotNull(), F.struct(*columns)),
        message("start", in_start, F.struct("common", "start", "ts", *carry)),
        message("page", ~in_start & F.col("page").isNotNull(), F.struct("common", "page", "ts", *carry)),
    )

    def each(branch: str, array: str, own_time: bool) -> Column:
        inner = _element_fields(records, array)

        def one(element: Column) -> Column:
            value = F.struct(*_laid_over(records, element, inner, own_time), *carry) if elements is None else element
            return F.struct(F.lit(branch).alias("branch"), F.to_json(value).alias("value"))

        rows = F.col(array) if elements is None else elements[own_time]
        return F.when(~in_start & F.col(array).isNotNull(), F.transform(rows, one))

    none = F.array().cast("array<struct<branch:string,value:string>>")
    messages = F.concat(
        F.filter(ones, lambda m: m.isNotNull()),
        F.coalesce(each("display", "displays", False), none),
        F.coalesce(each("action", "actions", True), none),
    )
    return given.select(F.explode(messages).alias("_m")).select("_m.*")


def route_changes(upserts: DataFrame, config: DataFrame) -> DataFrame:
    """Dimension rows to write: sink table, key, kept columns as a map, change type and time.

    A change row whose table is not configured is dropped. Only configured columns stay in the map; a
    configured column the change row lacks is added as NULL, so a dimension row always has all of
    them. ``position`` is the place of the row in its feed, such as an offset, if the rows have one.
    """
    wanted = F.split("sink_columns", ",")
    routes = config.select(
        F.col("source_table").alias("table"),
        "sink_table",
        wanted.alias("_wanted"),
        F.coalesce("sink_pk", F.lit("id")).alias("_pk"),
    )
    kept = F.map_from_arrays("_wanted", F.transform("_wanted", lambda name: F.col("data")[name]))
    return upserts.join(routes, "table").select(
        "sink_table",
        F.col("data")[F.col("_pk")].alias("id"),
        kept.alias("data"),
        F.col("type").alias("operate_type"),
        "ts",
        (F.col("position") if "position" in upserts.columns else F.lit(None)).cast("long").alias("position"),
    )


def dimension_table(routed: DataFrame, sink_table: str, columns: str) -> DataFrame:
    """One typed dimension table out of routed rows."""
    return routed.where(F.col("sink_table") == sink_table).select(
        *[F.col("data")[name].alias(name) for name in columns.split(",")]
    )

"""GTFS-RT flattening: poll payloads -> the six warehouse fact tables.

A poll is one JSON document ``{"entity": [...]}`` (one file per poll on
disk). Everything here is a DataFrame transform over *many* polls at once:
``from_json`` with the declared schema, ``posexplode`` of the entity list
and of each child array, and column selection. Keys are the poll's 128-bit
id and positions in it, known before the children are exploded, so parents
and children agree without a write-back and a replay of the same file
yields the same keys (KEY-1, KEY-2).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.timecols import epoch_to_ts, utc_ntz
from tramline.sources.schemas import ALERT, FACT_WIDTHS, FEED_MESSAGE, TRIP_UPDATE

# The run summary's label when no station filter is given, its
# status value, and the alert text fields with the feed objects they come from.
NO_FILTER_LABEL = "None (Full Network)"
STATUS_OK = "ok"
TEXT_FIELDS = (("header", "headerText"), ("description", "descriptionText"), ("url", "url"))


# ----------------------------------------------------------------- SRC-3
_CORRUPT = "_malformed"
_POLL_SCHEMA = T.StructType([*FEED_MESSAGE.fields, T.StructField(_CORRUPT, T.StringType())])


def poll_time(msg: Column, file_mtime: Column) -> Column:
    """STR-2: the poll stamp — the feed header's timestamp, else the file's mtime."""
    return F.coalesce(epoch_to_ts(msg["header"]["timestamp"]), utc_ntz(file_mtime))


def poll_columns(raw: DataFrame, feed: str) -> DataFrame:
    """Text polls (``value`` and file metadata) -> feed, source_file, poll_id, fetched_at, msg, malformed.

    ``poll_id`` is a 128-bit hash of feed, file and text: it comes from the
    data, so a replay gives it again whatever batch the poll is in.
    ``malformed`` is the text of a poll that is no JSON, or has a value that
    does not fit its declared type; NULL for a sound poll.
    """
    named = raw.select(F.lit(feed).alias("feed"), F.col("_metadata.file_path").alias("source_file"),
                       F.col("_metadata.file_modification_time").alias("_mtime"), "value")
    parsed = parse_polls(named, "value")
    return parsed.select("feed", "source_file", "poll_id", poll_time(F.col("msg"), F.col("_mtime")).alias("fetched_at"),
                         "msg", "malformed")


def read_poll_files(spark: SparkSession, path: str, feed: str,
                    one_poll_per_file: bool = True) -> DataFrame:
    """Poll files -> one row per poll (see ``poll_columns``).

    ``one_poll_per_file``: each file is one (multi-line) JSON document, as a
    poller writes it; otherwise JSON lines, one poll per line, which Spark
    splits across tasks; a line repeated word for word in a file is one poll.
    ``fetched_at`` is the header timestamp, else the file's modification time
    (both stable on replay).
    """
    raw = spark.read.text(path, wholetext=one_poll_per_file)
    polls = poll_columns(raw, feed)
    return polls if one_poll_per_file else polls.dropDuplicates(["poll_id"])


def parse_polls(polls: DataFrame, payload: str = "payload") -> DataFrame:
    """Poll rows carrying the JSON text -> the same rows with ``poll_id``, ``msg`` and ``malformed``."""
    text = F.col(payload)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = polls.withColumn("_msg", F.from_json(text, _POLL_SCHEMA, options)).withColumn(
        "poll_id", F.md5(F.concat_ws("\u0001", "feed", "source_file", text)))
    broken = F.col("_msg").isNull() | F.col(f"_msg.{_CORRUPT}").isNotNull()
    return (parsed.withColumn("malformed", F.when(broken, text))
            .withColumn("msg", F.struct(*[F.col(f"_msg.{c}").alias(c) for c in FEED_MESSAGE.fieldNames()]))
            .drop("_msg", payload))


def entities(polls: DataFrame) -> DataFrame:
    """One row per feed entity; a poll without ``entity`` gives no rows.

    ``entity_key`` = poll id and position in the poll: no two entities share
    one, and children add their own position to it (KEY-1, KEY-2).
    """
    # an expression, not a bare column: for a column Spark adds the filters "not null" and "size above 0",
    # pushes them below the parser's projection and so parses every poll again for them
    listed = F.coalesce(F.col("msg.entity"), F.array())
    e = polls.select("feed", "source_file", "poll_id", "fetched_at",
                     F.posexplode(listed).alias("entity_pos", "entity"))
    return e.withColumn("entity_key", _key("poll_id", "entity_pos"))


def _key(*parts) -> Column:
    return F.concat_ws("-", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])


def poll_of(key) -> Column:
    """The poll id that a key begins with."""
    return F.substring(key, 1, 32)


# ------------------------------------------------------------------- F-6
def _present(struct_col: Column, fields) -> Column:
    """A JSON object that is present and not ``{}``.

    With a declared schema ``{}`` parses to a struct whose fields are all
    NULL; the reference treats it as absent (an empty dict is falsy).
    """
    return struct_col.isNotNull() & reduce(lambda a, b: a | b,
                                           [struct_col[f].isNotNull() for f in fields])


def trip_update_entities(ents: DataFrame) -> DataFrame:
    return ents.filter(_present(F.col("entity.tripUpdate"), TRIP_UPDATE.fieldNames()))


def alert_entities(ents: DataFrame) -> DataFrame:
    return ents.filter(_present(F.col("entity.alert"), ALERT.fieldNames()))


def entity_kind(ents: DataFrame) -> DataFrame:
    """F-6 as a column: 'trip_update', 'alert', 'both' or 'none'."""
    tu = _present(F.col("entity.tripUpdate"), TRIP_UPDATE.fieldNames())
    al = _present(F.col("entity.alert"), ALERT.fieldNames())
    return ents.withColumn("kind", F.when(tu & al, "both").when(tu, "trip_update")
                           .when(al, "alert").otherwise("none"))


# ------------------------------------------------------------- F-8, F-9
def resolve_station_ids(dim_stations: DataFrame, station_input) -> DataFrame | None:
    """F-8: station text or id -> DataFrame of stop_ids (None = no filter).

    Falsy input -> None; all-digit input -> that id, unchecked; otherwise the
    ids whose name contains the text (case-insensitive; ``%`` and ``_`` in
    the text act as wildcards, as in the reference's LIKE).
    """
    if not station_input:
        return None
    s = str(station_input).strip()
    spark = dim_stations.sparkSession
    if s.isdigit():
        return spark.createDataFrame([(s,)], "stop_id string")
    return (dim_stations.filter(F.col("stop_name").ilike(f"%{s}%"))
            .select(F.col("stop_id").cast("string").alias("stop_id")).distinct())


SALTS = 256


def _own_and_stop_rows(ents: DataFrame, *carried) -> DataFrame:
    """entity_key, ``carried``, _salt, stop_id: a row of each entity's own and one for each of its stops.

    One explode gives both, so the polls are parsed once for them. The own
    row has a ``_salt`` of 0 to SALTS - 1, by hash, so that no task gets all
    entities, and no stop; a stop has -1. Stops without an id match nothing
    and are left out.
    """
    salt = F.pmod(F.xxhash64("entity_key"), F.lit(SALTS)).cast("int")
    own = F.array(F.struct(salt.alias("_salt"), F.lit("").alias("stop_id")))
    stops = F.transform("entity.tripUpdate.stopTimeUpdate",
                        lambda s: F.struct(F.lit(-1).alias("_salt"), s["stopId"].alias("stop_id")))
    keyed = ents.select("entity_key", *carried)
    rows = ents.select("entity_key", *carried, F.explode(F.concat(own, F.coalesce(stops, F.array()))).alias("_row"))
    return rows.select(*keyed.columns, "_row._salt", "_row.stop_id").filter("stop_id IS NOT NULL")


def trips_at(trip_ents: DataFrame, stop_ids: DataFrame, on_no_match: str = "all") -> DataFrame:
    """F-9: the ``entity_key`` of every trip entity that ANY stop id of ``stop_ids`` lets through.

    Only (entity, stop) pairs meet the ids, in a join that Spark may shuffle,
    so neither the ids nor an entity's stops need fit anywhere. An empty id
    set means "no filter" in the reference (T-1, ``on_no_match='all'``);
    ``on_no_match='none'`` then matches nothing instead. An entity that is
    let through twice is there twice.
    """
    wanted = stop_ids.select(F.lit(-1).alias("_salt"), "stop_id")
    if on_no_match == "all":
        # if there is no id: a row for each of SALTS, which the entities' own rows meet; else none
        wanted = wanted.unionByName(stop_ids.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0").select(
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.lit("").alias("stop_id")))
    return _own_and_stop_rows(trip_ents).join(wanted, ["_salt", "stop_id"], "left_semi").select("entity_key")


def filter_trips_by_stations(trip_ents: DataFrame, stop_ids: DataFrame | None,
                             on_no_match: str = "all") -> DataFrame:
    """F-9: keep a trip entity if ANY of its stops is in ``stop_ids`` (None = no filter).

    Kept trips keep ALL their stops (T-2). The keys let through, each once,
    are the hashed side of the join, so the wide entities are not sorted.
    """
    if stop_ids is None:
        return trip_ents
    through = trips_at(trip_ents, stop_ids, on_no_match).distinct().hint("shuffle_hash")
    return trip_ents.join(through, "entity_key", "left_semi").select(*trip_ents.columns)


# --------------------------------------------------------------- JSN-3/4
def trip_updates(trip_ents: DataFrame) -> DataFrame:
    """JSN-3: one header row per kept trip entity."""
    tu = F.col("entity.tripUpdate")
    return trip_ents.select(
        F.col("entity_key").alias("update_pk"),
        F.col("entity.id").alias("entity_id"),
        tu["trip"]["tripId"].alias("trip_id"),
        tu["trip"]["routeId"].alias("route_id"),
        tu["trip"]["startDate"].alias("start_date"),
        tu["trip"]["startTime"].alias("start_time"),
        tu["trip"]["scheduleRelationship"].alias("trip_schedule_relationship"),
        tu["vehicle"]["id"].alias("vehicle_id"),
        tu["vehicle"]["label"].alias("vehicle_label"),
        tu["vehicle"]["licensePlate"].alias("license_plate"),
        tu["delay"].alias("overall_delay"),
        epoch_to_ts(tu["timestamp"]).alias("update_timestamp"),
        "fetched_at", "feed", "source_file",
    )


def _carry(carry) -> list:
    """Parent columns copied onto child rows, e.g. ``{"entity_id": "entity.id"}``."""
    return [F.col(src).alias(name) for name, src in (carry or {}).items()]


def trip_stop_updates(trip_ents: DataFrame, carry: dict | None = None) -> DataFrame:
    """JSN-4: one row per stopTimeUpdate; missing sequence -> 0.

    Plain ``posexplode`` (not ``_outer``): a trip without stops keeps its
    header and yields no stop row. ``carry`` copies parent columns onto the
    children in the same pass (no join back to the parent).
    """
    e = trip_ents.select(F.col("entity_key").alias("update_pk"), *_carry(carry),
                         F.posexplode("entity.tripUpdate.stopTimeUpdate").alias("pos", "s"))
    s = F.col("s")
    return e.select(
        *list(carry or {}),
        _key("update_pk", "pos").alias("id"),
        "update_pk",
        F.coalesce(s["stopSequence"], F.lit(0)).alias("stop_sequence"),
        s["stopId"].alias("stop_id"),
        epoch_to_ts(s["arrival"]["time"]).alias("arrival_time"),
        s["arrival"]["delay"].alias("arrival_delay"),
        epoch_to_ts(s["departure"]["time"]).alias("departure_time"),
        s["departure"]["delay"].alias("departure_delay"),
        s["scheduleRelationship"].alias("schedule_relationship"),
    )


# ------------------------------------------------------------- JSN-5/6/7
def service_alerts(alert_ents: DataFrame) -> DataFrame:
    """JSN-5: one row per alert entity."""
    return alert_ents.select(
        F.col("entity_key").alias("alert_pk"), F.col("entity.id").alias("entity_id"),
        F.col("entity.alert.cause").alias("cause"), F.col("entity.alert.effect").alias("effect"),
        "fetched_at", "feed", "source_file")


def alert_active_periods(alert_ents: DataFrame, carry: dict | None = None) -> DataFrame:
    """JSN-5: one row per active period (an empty list gives none)."""
    e = alert_ents.select(F.col("entity_key").alias("alert_pk"), *_carry(carry),
                          F.posexplode("entity.alert.activePeriod").alias("pos", "p"))
    return e.select(*list(carry or {}),
                    _key("alert_pk", "pos").alias("id"), "alert_pk",
                    epoch_to_ts(F.col("p.start")).alias("period_start"),
                    epoch_to_ts(F.col("p.end")).alias("period_end"))


def alert_texts(alert_ents: DataFrame, carry: dict | None = None) -> DataFrame:
    """JSN-6: header / description / url translations stacked in one pass.

    The three fields are unpivoted with ``explode(array(struct ...))`` and
    their ``translation`` arrays exploded — one scan, no union.
    """
    fields = F.array(*[F.struct(F.lit(name).alias("field_name"),
                                F.col(f"entity.alert.{src}.translation").alias("tr"))
                       for name, src in TEXT_FIELDS])
    e = alert_ents.select(F.col("entity_key").alias("alert_pk"), *_carry(carry),
                          F.explode(fields).alias("f"))
    e = e.select("alert_pk", *list(carry or {}), F.col("f.field_name").alias("field_name"),
                 F.posexplode("f.tr").alias("pos", "t"))
    return e.select(*list(carry or {}),
                    _key("alert_pk", "field_name", "pos").alias("id"), "alert_pk",
                    "field_name", F.col("t.language").alias("language"),
                    F.col("t.text").alias("text_value"))


def alert_informed_entities(alert_ents: DataFrame, carry: dict | None = None) -> DataFrame:
    """JSN-7: one row per informed entity, trip sub-object flattened."""
    e = alert_ents.select(F.col("entity_key").alias("alert_pk"), *_carry(carry),
                          F.posexplode("entity.alert.informedEntity").alias("pos", "i"))
    i = F.col("i")
    return e.select(
        *list(carry or {}),
        _key("alert_pk", "pos").alias("id"), "alert_pk",
        i["agencyId"].alias("agency_id"), i["routeId"].alias("route_id"),
        i["routeType"].alias("route_type"), i["trip"]["tripId"].alias("trip_id"),
        i["trip"]["startDate"].alias("trip_start_date"),
        i["trip"]["startTime"].alias("trip_start_time"),
        i["trip"]["scheduleRelationship"].alias("trip_schedule_relationship"),
        i["stopId"].alias("stop_id"),
    )


# ----------------------------------------------------------------- SNK-6
COUNTS = ("total_trips_fetched", "trips_inserted", "alerts_processed")


def ingest_summary(trip_feed_ents: DataFrame, alert_ents: DataFrame, station_filter,
                   stop_ids: DataFrame | None, on_no_match: str = "all", by=()) -> DataFrame:
    """SNK-6: the run summary as one row, or one for each value of ``by`` (poll columns).

    Narrow flags of entities are unioned and summed, each task pre-sums its
    rows. With stop ids, one pass over the trip feed counts both the entities
    fetched and those the ids let through (as ``trips_at`` does). A writer
    counts while it writes instead (``streaming.ingest``).
    """
    is_trip = _present(F.col("entity.tripUpdate"), TRIP_UPDATE.fieldNames()).cast("int")
    one, none = F.lit(1), F.lit(0)
    ids = F.lit(0)
    if stop_ids is None:
        fetched = trip_feed_ents.select(*by, one.alias("f"), is_trip.alias("k"), none.alias("a"))
    else:
        ids = stop_ids.agg(F.count(F.lit(1))).scalar()
        wanted = stop_ids.select(F.lit(-1).alias("_salt"), "stop_id", one.alias("_hit"))
        own = (F.col("_salt") >= 0).cast("int")
        per_entity = (_own_and_stop_rows(trip_feed_ents, *by, is_trip.alias("_trip"))
                      .join(wanted, ["_salt", "stop_id"], "left").groupBy("entity_key", *by)
                      .agg(F.sum(own).alias("f"), F.sum(own * F.col("_trip")).alias("_trips"), F.max("_hit").alias("_hit")))
        let_through = F.col("_hit").isNotNull()
        if on_no_match == "all":
            let_through = let_through | (ids == 0)
        fetched = per_entity.select(*by, "f", F.when(let_through, F.col("_trips")).otherwise(0).alias("k"), none.alias("a"))
    u = fetched.unionByName(alert_ents.select(*by, none.alias("f"), none.alias("k"), one.alias("a")))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    sums = [total(c).alias(name) for c, name in zip("fka", COUNTS)]
    summed = u.groupBy(*by).agg(*sums) if by else u.agg(*sums)
    return summed.select(*by, F.lit(station_filter or NO_FILTER_LABEL).alias("station_filter"),
                         F.lit(STATUS_OK).alias("status"), ids.cast("bigint").alias("resolved_stop_ids_count"), *COUNTS)


# ------------------------------------------------------------- one call
# NOT NULL columns of the warehouse fact tables that come from the feed.
FACT_NOT_NULL = {
    "trip_updates": ["entity_id", "trip_id"],
    "trip_stop_updates": ["stop_sequence", "stop_id"],
    "service_alerts": ["entity_id"],
    "alert_texts": ["field_name"],
}


class InvalidFeedRows(ValueError):
    """Raised in ``strict`` mode for a malformed poll, or a fact row that breaks
    a NOT NULL column or is wider than its column."""


REJECTED = "table_name string, reason string, row_json string, poll_id string, fetched_at timestamp_ntz"


def _rejects(rows: DataFrame, table: str, reason: Column) -> DataFrame:
    """Rows as ``rejected`` keeps them, with their poll where they name it."""
    key = next((c for c in ("poll_id", "update_pk", "alert_pk") if c in rows.columns), None)
    stamp = F.col("fetched_at") if "fetched_at" in rows.columns else F.lit(None)
    return rows.select(F.lit(table).alias("table_name"), reason.alias("reason"),
                       F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("row_json"),
                       (poll_of(key) if key else F.lit(None).cast("string")).alias("poll_id"),
                       stamp.cast("timestamp_ntz").alias("fetched_at"))


def enforce_columns(tables: dict[str, DataFrame], mode: str = "keep") -> dict[str, DataFrame]:
    """T-3, CHK-5: rows that would break a NOT NULL column (e.g. a stop without
    ``stopId``) or are wider than their column.

    ``keep``: unchanged (lazy). ``strict``: like the reference's single
    commit — nothing is accepted if any row is bad (raises before writing).
    ``quarantine``: bad rows leave their table and go to ``rejected`` as
    (table, reason, row JSON); good rows are kept.
    """
    if mode == "keep":
        return tables
    out = dict(tables)
    rejected, broken = [], []
    for name, df in tables.items():
        breaks = [(F.col(c).isNull(), f"{c} is null") for c in FACT_NOT_NULL.get(name, [])]
        breaks += [(F.length(c) > n, f"{c} is wider than {n}") for c, n in FACT_WIDTHS.get(name, {}).items()]
        if not breaks:
            continue
        bad = F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c, _ in breaks]), F.lit(False))
        reason = F.concat_ws(",", *[F.when(c, F.lit(why)) for c, why in breaks])
        if mode == "strict":
            broken.append(df.filter(bad).select(F.concat(F.lit(f"{name}: "), reason).alias("why")))
            continue
        out[name] = df.filter(~bad)
        rejected.append(_rejects(df.filter(bad), name, reason))
    if mode == "strict":
        broken += [d.select(F.lit("service_alerts: duplicate (entity_id, fetched_at)").alias("why"))
                   for d in _repeated_alerts(tables)]
        first = reduce(DataFrame.unionByName, broken).first() if broken else None  # one job for all tables
        if first is not None:
            raise InvalidFeedRows(first[0])
        return out
    out, dup_rows = _enforce_unique_alerts(out)
    rejected.extend(dup_rows)
    if mode == "quarantine":
        spark = next(iter(tables.values())).sparkSession
        out["rejected"] = reduce(DataFrame.unionByName, rejected, spark.createDataFrame([], REJECTED))
    return out


ALERT_CHILDREN = ("alert_active_periods", "alert_texts", "alert_informed_entities")


def _repeated_alerts(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The alerts of a poll beyond the first with their id (lowest ``alert_pk``), if there is such a table."""
    if "service_alerts" not in tables:
        return []
    alerts = tables["service_alerts"]
    keep = alerts.groupBy("entity_id", "fetched_at").agg(F.min("alert_pk").alias("alert_pk"))
    return [alerts.join(keep, "alert_pk", "left_anti")]


def _enforce_unique_alerts(tables: dict[str, DataFrame]):
    """CHK-4: one alert per (entity_id, fetched_at).

    quarantine: keep the row with the lowest ``alert_pk``; the others and
    their child rows are diverted (no orphans are left behind).
    """
    if "service_alerts" not in tables:
        return tables, []
    alerts = tables["service_alerts"]
    keep = alerts.groupBy("entity_id", "fetched_at").agg(F.min("alert_pk").alias("alert_pk"))
    dups, = _repeated_alerts(tables)
    out = dict(tables)
    out["service_alerts"] = alerts.join(keep.select("alert_pk"), "alert_pk", "left_semi")
    bad_pk = dups.select("alert_pk")
    diverted = [_rejects(dups, "service_alerts", F.lit("duplicate (entity_id, fetched_at)"))]
    for name in ALERT_CHILDREN:
        if name in out:
            child = out[name]
            out[name] = child.join(bad_pk, "alert_pk", "left_anti")
            diverted.append(_rejects(child.join(bad_pk, "alert_pk", "left_semi"), name, F.lit("parent alert diverted")))
    return out, diverted


def sound_polls(polls: DataFrame, mode: str) -> tuple[DataFrame, DataFrame | None]:
    """SRC-3: polls to go on with, and the ``rejected`` rows of malformed ones.

    ``strict`` raises for a malformed poll, as the reference's parser does;
    ``quarantine`` diverts its raw text; ``keep`` goes on with what could be
    read of it. Polls without the column (built by hand) count as sound.
    """
    if mode == "keep" or "malformed" not in polls.columns:
        return polls, None
    broken = polls.filter("malformed IS NOT NULL")
    if mode == "strict":
        first = broken.select("source_file").first()
        if first is not None:
            raise InvalidFeedRows(f"malformed poll in {first[0]}")
        return polls, None
    return polls.filter("malformed IS NULL"), broken.select(
        F.lit("polls").alias("table_name"), F.concat(F.lit("malformed poll in "), "source_file").alias("reason"),
        F.col("malformed").alias("row_json"), "poll_id", "fetched_at")


def flatten(trip_polls: DataFrame, alert_polls: DataFrame,
            dim_stations: DataFrame | None = None, station_filter=None,
            on_no_match: str = "all", on_invalid: str = "keep", carry: dict | None = None,
            summary_by=()) -> dict[str, DataFrame]:
    """Both feeds -> the six fact tables and the summary (lazy DataFrames).

    Callers that write several outputs should persist the polls
    (``streaming.ingest`` does, per micro-batch) so JSON is parsed once.
    ``on_invalid`` handles malformed polls, NOT NULL breaks and overlong
    values: keep / strict / quarantine. ``carry`` copies poll columns onto
    the child rows.
    """
    trip_polls, bad_trips = sound_polls(trip_polls, on_invalid)
    alert_polls, bad_alerts = sound_polls(alert_polls, on_invalid)
    t_ents = entities(trip_polls)
    a_ents = alert_entities(entities(alert_polls))
    ids = (resolve_station_ids(dim_stations, station_filter)
           if dim_stations is not None else None)
    kept = filter_trips_by_stations(trip_update_entities(t_ents), ids, on_no_match)
    tables = enforce_columns({
        "trip_updates": trip_updates(kept),
        "trip_stop_updates": trip_stop_updates(kept, carry),
        "service_alerts": service_alerts(a_ents),
        "alert_active_periods": alert_active_periods(a_ents, carry),
        "alert_texts": alert_texts(a_ents, carry),
        "alert_informed_entities": alert_informed_entities(a_ents, carry),
        "summary": ingest_summary(t_ents, a_ents, station_filter, ids, on_no_match, summary_by),
    }, on_invalid)
    if bad_trips is not None:
        tables["rejected"] = tables["rejected"].unionByName(bad_trips).unionByName(bad_alerts)
    return tables

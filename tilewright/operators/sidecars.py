"""The archive's sidecar records: ``premet`` and ``spatial`` texts, and the item itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import names
from tilewright.functions.footprint import corners
from tilewright.functions.numbers import round_exact, shortest_text
from tilewright.operators.derive import stac_record

# Kind of sidecar -> file name ending.
SUFFIXES = {"stac": ".stac.json", "premet": ".nc.premet", "spatial": ".nc.spatial"}


def _short_name(token: Column, part: int) -> Column:
    table = F.create_map(*[F.lit(v) for t, s in names.SENSORS.items() for v in (t, s[part])])
    return F.try_element_at(table, token)


def sensor_lookup(df: DataFrame) -> DataFrame:
    """Adds platform and sensor short names of both images; null for unknown tokens.

    Eleven rows: a literal map instead of a join.
    """
    tokens = {f"token_{i}": names.sensor_token(F.col("url"), i) for i in (1, 2)}
    found = {
        f"{label}_{i}": _short_name(F.col(f"token_{i}"), part)
        for i in (1, 2)
        for part, label in enumerate(("platform", "sensor"))
    }
    return df.withColumns(tokens).withColumns(found)


def premet_text(version: Column) -> Column:
    """The record of dates and instruments; blanks removed, one trailing newline."""

    def clock(ts: Column) -> Column:
        return F.date_format(ts, "HH:mm:ss.SSS")

    lines = [
        F.concat(F.lit("FileName="), F.col("id")),
        F.concat(F.lit("VersionID_local="), version),
        F.concat(F.lit("Begin_date="), F.date_format("start_ts", "yyyy-MM-dd")),
        F.concat(F.lit("End_date="), F.date_format("end_ts", "yyyy-MM-dd")),
        F.concat(F.lit("Begin_time="), clock(F.col("start_ts"))),
        F.concat(F.lit("End_time="), clock(F.col("end_ts"))),
    ]
    for i in (1, 2):
        token = names.sensor_token(F.col("url"), i)
        sensor = _short_name(token, 1)
        lines += [
            F.lit("Container=AssociatedPlatformInstrumentSensor"),
            F.concat(F.lit("AssociatedPlatformShortName="), _short_name(token, 0)),
            F.concat(F.lit("AssociatedInstrumentShortName="), sensor),
            F.concat(F.lit("AssociatedSensorShortName="), sensor),
        ]
    return F.concat(F.replace(F.concat_ws("\n", *lines), F.lit(" "), F.lit("")), F.lit("\n"))


def spatial_text(ring: Column) -> Column:
    """Four corner lines ``lon<tab>lat`` with at most two decimals."""
    lines = F.transform(
        corners(ring),
        lambda p: F.concat(
            shortest_text(round_exact(p["lon"], 2)),
            F.lit("\t"),
            shortest_text(round_exact(p["lat"], 2)),
        ),
    )
    return F.concat(F.array_join(lines, "\n"), F.lit("\n"))


def sidecars(items: DataFrame, outdir: str | None = None) -> DataFrame:
    """Rows ``(id, kind, target_path, content)``, three per good item.

    Targets lie beside the data file, or in ``outdir``.
    """
    href = F.col("assets")["data"]["alternate"]["s3"]["href"]

    def entry(kind: str, content: Column) -> Column:
        suffix = SUFFIXES[kind]
        target = (
            names.sidecar_path(href, F.col("id"), suffix)
            if outdir is None
            else F.concat(F.lit(outdir.rstrip("/") + "/"), F.col("id"), F.lit(suffix))
        )
        return F.struct(
            F.lit(kind).alias("kind"), target.alias("target_path"), content.alias("content")
        )

    entries = F.array(
        entry("stac", F.to_json(stac_record(items))),
        entry("premet", premet_text(F.col("version"))),
        entry("spatial", spatial_text(F.col("ring"))),
    )
    return items.select("id", F.inline(entries))


def missing_sidecars(expected: DataFrame, written: DataFrame) -> DataFrame:
    """Ids lacking a sidecar, one flag per kind. ``written`` has ``id, kind``."""
    have = written.groupBy("id").agg(
        *[F.max((F.col("kind") == k).cast("int")).alias(f"has_{k}") for k in SUFFIXES]
    )
    joined = expected.select("id").join(have, "id", "left")
    flags = {k: F.coalesce(F.col(f"has_{k}") == 1, F.lit(False)) for k in SUFFIXES}
    anything = ~(flags["stac"] & flags["premet"] & flags["spatial"])
    lacking = F.concat_ws(",", *[F.when(~f, F.lit(k)) for k, f in flags.items()])
    return joined.filter(anything).select("id", lacking.alias("missing"))

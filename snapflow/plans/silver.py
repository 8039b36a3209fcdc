"""Bronze -> silver: drop ghost stations, type the columns, add change and rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.config import PipelineConfig
from snapflow.functions.exprs import yes_flag
from snapflow.operators.lag import with_delta_rate
from snapflow.operators.latest import latest_per_key
from snapflow.schemas import SILVER_COLUMNS

# Snapshot order per station.  ``ingested_at`` breaks ties between two polls
# that saw the same report time, so LAG is deterministic.
TIME_COL = "last_reported"
TIEBREAK = ("ingested_at",)


CLEANED_COLUMNS = SILVER_COLUMNS[:17]


def position(of: str = "") -> Column:
    """Sort position of a row under ``ORDER BY last_reported, ingested_at`` (NULLS LAST), hash as tie-break.

    ``of`` names a struct column that holds the row.
    """
    c = (lambda n: F.col(f"{of}.{n}")) if of else F.col
    lr, ing = c(TIME_COL), c("ingested_at")
    tie = F.xxhash64(*[c(n) for n in CLEANED_COLUMNS])
    return F.struct(lr.isNull().alias("a"), lr.alias("b"), ing.isNull().alias("c"), ing.alias("d"), tie.alias("e"))


def newest_first() -> list[Column]:
    """The reverse of ``position``."""
    tie = F.xxhash64(*CLEANED_COLUMNS)
    return [F.col(TIME_COL).desc_nulls_first(), F.col("ingested_at").desc_nulls_first(), tie.desc()]


def clean(bronze: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Keep installed stations with a code, a name and capacity; rename and type (``extra`` columns stay)."""
    kept = bronze.where(
        (F.col("is_installed") == "OUI")
        & F.col("stationcode").isNotNull()
        & F.col("name").isNotNull()
        & (F.col("capacity") > 0)
    )
    return kept.select(
        F.col("stationcode").alias("station_code"),
        F.col("name").alias("station_name"),
        F.col("nom_arrondissement_communes").alias("arrondissement"),
        F.col("code_insee_commune").alias("code_insee"),
        F.col("numbikesavailable").alias("bikes_available"),
        F.col("mechanical").alias("bikes_mechanical"),
        F.col("ebike").alias("bikes_electric"),
        F.col("numdocksavailable").alias("docks_available"),
        F.col("capacity"),
        yes_flag("is_installed").alias("is_installed"),
        yes_flag("is_renting").alias("is_renting"),
        yes_flag("is_returning").alias("is_returning"),
        F.col("`coordonnees_geo.lat`").alias("latitude"),
        F.col("`coordonnees_geo.lon`").alias("longitude"),
        # Offsets in the text are dropped, not applied: the wall-clock value is kept.
        F.col("duedate").cast("timestamp_ntz").alias("last_reported"),
        F.col("ingested_at"),
        F.col("date"),
        *extra,
    )


def enrich(
    cleaned: DataFrame, cfg: PipelineConfig | None = None, extra: Sequence[str] = (), hot: DataFrame | None = None
) -> DataFrame:
    """LAG over *all* rows of a station (across days), then change per minute.

    Every row stays, rows equal in all columns too.  ``hot`` is a kept
    statistic of the stations with most rows (``operators.lag.heavy_keys``).
    """
    rows_per_slice = cfg.rows_per_slice if cfg else None
    broadcast_max = cfg.broadcast_max_rows if cfg else 1_000_000
    out = with_delta_rate(
        cleaned,
        ["station_code"],
        TIME_COL,
        TIEBREAK,
        "bikes_available",
        prev_col="prev_bikes_available",
        delta_col="bikes_delta",
        minutes_col="minutes_since_last_snapshot",
        rate_col="depletion_rate_per_minute",
        rate_digits=4,
        rows_per_slice=rows_per_slice,
        broadcast_max_rows=broadcast_max,
        tie_cols=CLEANED_COLUMNS,
        hot=hot,
    )
    if out.columns == [*SILVER_COLUMNS, *extra]:
        return out
    return out.select(*SILVER_COLUMNS, *extra)


def build_silver(
    bronze: DataFrame, cfg: PipelineConfig | None = None, extra: Sequence[str] = (), hot: DataFrame | None = None
) -> DataFrame:
    """Full silver from every bronze row.  Filter ``date`` only on the result:
    a day's first snapshot takes its predecessor from the day before."""
    return enrich(clean(bronze, extra), cfg, extra, hot)


def build_silver_after(
    history: DataFrame,
    bronze: DataFrame,
    cfg: PipelineConfig | None = None,
    extra: Sequence[str] = (),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Silver of the bronze rows when earlier bronze has expired.

    ``history`` holds the kept silver rows of the expired days.  They only
    serve as predecessors (four of their columns are read, and of each station
    only rows that can matter); they are not part of the result.
    """
    new = clean(bronze, extra)
    low = new.groupBy(F.col("station_code").alias("__station")).agg(F.min(position()).alias("__low"))
    kept = history.select(*CLEANED_COLUMNS).join(low, F.col("station_code") == F.col("__station"))
    before = latest_per_key(kept.where(position() < F.col("__low")), ["station_code"], newest_first())
    after = kept.where(position() >= F.col("__low"))
    old = before.select(*CLEANED_COLUMNS).unionByName(after.select(*CLEANED_COLUMNS))
    both = old.withColumn("__old", F.lit(True)).unionByName(new.withColumn("__old", F.lit(False)), allowMissingColumns=True)
    return enrich(both, cfg, [*extra, "__old"], hot).where(~F.col("__old")).drop("__old")

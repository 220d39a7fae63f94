"""The one registry of questions, behind the page, the agent and the tool interface alike."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreflow.functions.columns import years_before
from acreflow.operators import assemblages, links, ownership, permits, proximity, runlog, score
from acreflow.plans.params import Params


@dataclass
class Tables:
    """The curated tables that a tool may need."""

    property: DataFrame | None = None
    transfer: DataFrame | None = None
    permit: DataFrame | None = None
    poi: DataFrame | None = None
    owner: DataFrame | None = None
    contractor: DataFrame | None = None
    business: DataFrame | None = None
    location: DataFrame | None = None
    zoning: DataFrame | None = None
    entity_map: DataFrame | None = None
    run_log: DataFrame | None = None
    artifact: DataFrame | None = None


@dataclass(frozen=True)
class Tool:
    name: str
    description: str
    parameters: dict[str, tuple[type, object]]  # name -> (type, default)
    needs: tuple[str, ...]
    run: Callable[..., DataFrame]
    reasoning: str = ""
    assumptions: tuple[str, ...] = field(default=())


TOOLS: dict[str, Tool] = {}
_P = Params()


def tool(name: str, description: str, needs: tuple[str, ...], reasoning: str = "", assumptions: tuple[str, ...] = (), **parameters: object):
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        TOOLS[name] = Tool(name, description, {k: (type(v), v) for k, v in parameters.items()}, needs, f, reasoning, assumptions)
        return f

    return add


def typed(kind: type, value: object) -> object:
    """A caller's value as a parameter's type; raises ``ValueError`` if it cannot be."""
    if isinstance(value, kind) and not (kind is not bool and isinstance(value, bool)):
        return value
    if kind is dt.date:
        return dt.date.fromisoformat(str(value))
    if kind is bool:
        if str(value).lower() in ("true", "false", "1", "0"):
            return str(value).lower() in ("true", "1")
        raise ValueError(f"not a boolean: {value!r}")
    return kind(value)


def run_tool(name: str, tables: Tables, **arguments: object) -> DataFrame:
    """The rows of a tool; unknown tools, parameters and missing tables raise ``ValueError``."""
    if name not in TOOLS:
        raise ValueError(f"no such tool: {name}")
    t = TOOLS[name]
    if unknown := set(arguments) - set(t.parameters):
        raise ValueError(f"{name} has no parameter {', '.join(sorted(unknown))}")
    if lacking := [n for n in t.needs if getattr(tables, n) is None]:
        raise ValueError(f"{name} needs the table {', '.join(lacking)}")
    values = {k: typed(kind, arguments.get(k, default)) for k, (kind, default) in t.parameters.items()}
    return t.run(tables, **values)


def _with_evidence(parcels: DataFrame, transfers: DataFrame) -> DataFrame:
    """Parcels with their ownership history and, as JSON, what an answer rests on."""
    out = parcels.join(ownership.history(transfers), "property_id", "left")
    parts = {c: F.col(c) for c in ("property_id", "acreage", "last_transfer", "n_transfers", "basis", "prov") if c in out.columns}
    return score.with_evidence(out, parts)


def _untouched(t: Tables, min_acres: float, years: int, as_of: dt.date, inclusive: bool) -> DataFrame:
    """Parcels of a least size (0: any) without a recorded transfer within the years, with the last one before."""
    since = years_before(as_of, years) + dt.timedelta(days=int(inclusive))
    large = t.property.filter(F.col("acreage") >= F.lit(min_acres)) if min_acres > 0 else t.property
    out = ownership.no_transfer_since(large, t.transfer, since).join(ownership.last_transfers(t.transfer), "property_id", "left")
    return out.withColumn("n_transfers", F.coalesce("n_transfers", F.lit(0)))


def _words(text: str) -> tuple[str, ...]:
    return tuple(w.strip().upper() for w in text.split(",") if w.strip())


def _zoned(t: Tables) -> DataFrame:
    """Properties with the zoning table's code where it has one."""
    if t.zoning is None:
        return t.property
    return links.with_zoning(t.property, t.zoning).withColumn("zoning", F.coalesce("zoning_code", "zoning")).drop("zoning_code", "land_use_code", "zoned_on")


def _signals(t: Tables, parcels: DataFrame, zones: str, permit_types: str, least: int, metres: float, max_lat: float) -> DataFrame:
    spots = t.poi.filter("lower(kind) = 'power'").select("poi_id", "lat", "lon")
    return links.power_or_industrial(parcels, t.permit, spots, F.upper("permit_type").isin(*_words(permit_types)), _words(zones), least, metres, max_lat)


_SIGNAL = {"zones": ",".join(_P.industrial_zones), "permit_types": ",".join(_P.industrial_permits), "least": 1, "metres": _P.power_m, "max_lat": 60.0}


@tool("stable_parcels", "Parcels of a least size whose ownership has not changed for years, with their ownership history.", ("property", "transfer"), "acreage is at least {min_acres} acres and the last recorded transfer is more than {years} years before {as_of}", ("a parcel without any recorded transfer has an unknown tenure and is left out",), min_acres=_P.min_acres, years=_P.tenure_years, as_of=_P.as_of, inclusive=_P.inclusive)
def stable_parcels(t: Tables, min_acres: float, years: int, as_of: dt.date, inclusive: bool) -> DataFrame:
    large = t.property.filter(F.col("acreage") >= F.lit(min_acres))
    return _with_evidence(ownership.tenure_over(large, t.transfer, as_of, years, inclusive), t.transfer)


@tool("no_transfer_since", "Parcels without a recorded transfer within some years, those with none at all included.", ("property", "transfer"), "no transfer is recorded within {years} years before {as_of}, and acreage is at least {min_acres} acres", ("a parcel without any recorded transfer counts as not transferred",), min_acres=0.0, years=_P.tenure_years, as_of=_P.as_of, inclusive=_P.inclusive)
def no_transfer_since(t: Tables, min_acres: float, years: int, as_of: dt.date, inclusive: bool) -> DataFrame:
    return _with_evidence(_untouched(t, min_acres, years, as_of, inclusive), t.transfer)


@tool("stable_with_signals", "Larger parcels without a recorded transfer within some years that have a power or industrial signal, with basis and history.", ("property", "transfer", "permit", "poi"), "acreage is at least {min_acres} acres, no transfer is recorded within {years} years before {as_of}, and power lies within {metres} m or permits or zoning point to industrial use", ("a parcel without any recorded transfer counts as not transferred", "distances are straight lines"), min_acres=_P.min_acres, years=_P.tenure_years, as_of=_P.as_of, inclusive=_P.inclusive, **_SIGNAL)
def stable_with_signals(t: Tables, min_acres: float, years: int, as_of: dt.date, inclusive: bool, **signal: object) -> DataFrame:
    stable = _untouched(t, min_acres, years, as_of, inclusive).join(_zoned(t).select("property_id", F.col("zoning").alias("__zoning")), "property_id", "left")
    return _with_evidence(_signals(t, stable.withColumn("zoning", F.col("__zoning")).drop("__zoning"), **signal), t.transfer)


@tool("power_or_industrial", "Parcels near power infrastructure or with permits or zoning that point to industrial use, with the basis.", ("property", "permit", "poi"), "power lies within {metres} m, or permits or zoning point to industrial use", ("distances are straight lines",), **_SIGNAL)
def power_or_industrial(t: Tables, **signal: object) -> DataFrame:
    return _signals(t, _zoned(t), **signal)


@tool("water_views", "Parcels with a view of water, as a source says or by nearness.", ("property", "poi"), "a source says so, or water lies within {metres} m", ("without a source's own flag a view is taken as nearness",), metres=_P.water_m, max_lat=60.0)
def water_views(t: Tables, metres: float, max_lat: float) -> DataFrame:
    spots = t.poi.filter("lower(kind) = 'water'").select("poi_id", "lat", "lon")
    return links.water_view(t.property, spots, metres, max_lat, "water_flag" if "water_flag" in t.property.columns else None).filter("water_view")


@tool("totals_by_source", "Total uploaded records by table and source, with the times of their collection.", (), "counted over all uploaded tables with provenance")
def totals_by_source(t: Tables) -> DataFrame:
    kinds = ("property", "transfer", "owner", "permit", "contractor", "business", "location", "zoning", "poi")
    there = [(k, df) for k in kinds if (df := getattr(t, k)) is not None and "prov" in df.columns]
    if not there:
        raise ValueError("no table with provenance is loaded")
    parts = [runlog.totals_by_source(df.select(F.lit(k).alias("dataset"), "prov.source_id", "prov.collected_at"), "dataset", "source_id", collected_at="collected_at") for k, df in there]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@tool("old_roofs", "Parcels whose roof is older than some years.", ("property", "permit"), "the last roofing permit, or else the building, is more than {years} years old at {as_of}", ("without a roofing permit the roof is as old as the building",), years=_P.roof_years, as_of=_P.as_of)
def old_roofs(t: Tables, years: int, as_of: dt.date) -> DataFrame:
    return permits.roof_age(t.property, t.permit, as_of, years, F.lower("permit_type").contains("roof")).filter("old_roof")


@tool("near_places", "Parcels within a straight-line distance of places of one kind: transit, starbucks, power, water.", ("property", "poi"), "a place of kind {kind} lies within {metres} m", ("distances are straight lines, not routes", "a view of water is taken as nearness to it"), kind="transit", metres=_P.walking_m, max_lat=60.0)
def near_places(t: Tables, kind: str, metres: float, max_lat: float) -> DataFrame:
    spots = t.poi.filter(F.lower("kind") == kind.lower()).select("poi_id", "lat", "lon")
    found = proximity.nearest(t.property, spots, "property_id", "poi_id", metres, max_lat, bounded=True)
    return t.property.join(found, "property_id").withColumn("basis", F.array(F.format_string("%s within %.0f m", F.lit(kind), F.col("distance_m"))))


@tool("industrial_signals", "Parcels with permits or zoning that point to industrial or data-center use.", ("property", "permit"), "permits or zoning point to industrial use", zones=",".join(_P.industrial_zones), permit_types=",".join(_P.industrial_permits), least=1)
def industrial_signals(t: Tables, zones: str, permit_types: str, least: int) -> DataFrame:
    kinds = [k.strip().upper() for k in permit_types.split(",") if k.strip()]
    is_signal = F.upper("permit_type").isin(kinds)
    return permits.industrial_signal(_zoned(t), t.permit, is_signal, tuple(z.strip() for z in zones.split(",") if z.strip()), least).filter("industrial")


@tool("assemblages", "Groups of adjacent parcels of one owner with a least total acreage.", ("property",), "parcels of one owner within {metres} m of each other add up to at least {min_acres} acres", ("adjacency is the distance of parcel points",), min_acres=_P.min_acres, metres=_P.adjacent_m, least=2, max_lat=60.0)
def find_assemblages(t: Tables, min_acres: float, metres: float, least: int, max_lat: float) -> DataFrame:
    return assemblages.assemblages(t.property, metres, min_acres, least, max_lat)


@tool("owner_areas", "Parcels by where their owner is: local, regional, out_of_area, unknown.", ("property", "owner"), "the owner's mailing address is {area}", area="out_of_area")
def owner_areas(t: Tables, area: str) -> DataFrame:
    both = t.property.join(t.owner, "owner_id", "left")
    names = ("zip", "city", "state")
    return ownership.owner_area(both, {n: f"mail_{n}" for n in names}, {n: f"situs_{n}" for n in names}).filter(F.col("owner_area") == area)


@tool("candidates", "Parcels ranked for data-center review by size, tenure and distance to power, on what is known of each.", ("property", "transfer"), "ranked by size, time since the last transfer and distance to power, each between 0 and 1, over what is known", ("components that are not known are left out of a parcel's mean",), k=20, as_of=_P.as_of, full_acres=200.0, full_years=20.0, power_m=_P.power_m, max_lat=60.0)
def candidates(t: Tables, k: int, as_of: dt.date, full_acres: float, full_years: float, power_m: float, max_lat: float) -> DataFrame:
    both = t.property.join(ownership.last_transfers(t.transfer), "property_id", "left")
    if t.poi is not None:
        spots = t.poi.filter("lower(kind) = 'power'").select("poi_id", "lat", "lon")
        both = both.join(proximity.nearest(t.property, spots, "property_id", "poi_id", power_m, max_lat, bounded=True), "property_id", "left")
    else:
        both = both.withColumn("distance_m", F.lit(None).cast("double"))
    years = F.datediff(F.lit(as_of), "last_transfer") / 365.25
    parts = {"size": score.bucket_rank(F.col("acreage").cast("double"), 0, full_acres), "tenure": score.bucket_rank(years, 0, full_years), "power": score.bucket_rank(F.col("distance_m"), 0, power_m, "low")}
    return score.top(score.ranked(both, "property_id", parts, _P.weights, F.array(F.lit("distances are straight lines"))), "property_id", k)


@tool("run_summary", "Completed loads: sources, record counts, times, limitations.", ("run_log",), "from the run log")
def run_summary(t: Tables) -> DataFrame:
    return runlog.run_summary(t.run_log, "run_id", "source_id")


@tool("artifacts", "Published files with their content identifiers.", ("artifact",), "from the manifest")
def artifacts(t: Tables) -> DataFrame:
    return t.artifact


def catalogue() -> list[dict]:
    """Name, description and JSON schema of the parameters of each tool."""
    kinds = {int: "integer", float: "number", bool: "boolean", str: "string", dt.date: "string"}
    schema = lambda t: {"type": "object", "additionalProperties": False, "properties": {k: {"type": kinds[kind], "default": str(d) if kind is dt.date else d} | ({"format": "date"} if kind is dt.date else {}) for k, (kind, d) in t.parameters.items()}}
    return [{"name": t.name, "description": t.description, "inputSchema": schema(t)} for t in TOOLS.values()]


def register_sql_functions(spark: SparkSession) -> None:
    """SQL table functions over views named property and transfer, for callers that speak SQL."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION stable_parcels(min_acres DOUBLE, before DATE) RETURNS TABLE (property_id BIGINT, acreage DECIMAL(12,4), last_transfer DATE)
        RETURN SELECT p.property_id, p.acreage, t.last_transfer FROM property p JOIN (SELECT property_id, max(transfer_date) AS last_transfer FROM transfer GROUP BY property_id) t ON t.property_id = p.property_id
        WHERE p.acreage >= stable_parcels.min_acres AND t.last_transfer < stable_parcels.before""")

"""Snapshot of a year, and trends over years, as plans over DataFrames."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealens.functions.scalar import divide
from arealens.operators.access import TIME_BREAKS, long_access
from arealens.operators.aggregate import Summary, column_sums, summarize_all
from arealens.operators.joins import PSEUDO_YEARS, difference, extend, feature_difference, join_specs, stack_years
from arealens.plans import report_specs as rs
from arealens.session import cut
from arealens.skew import advise, attach_scalars, spread_join
from arealens.specs import CalcSpec, FeatureSpec, SummarySpec, TableSpec, apply_calcs

# Reading order of a membership table: the target layer's key, then the source layer's.
Members = Mapping[tuple[str, str], DataFrame]


def _inputs(spec: CalcSpec) -> set[str]:
    """Columns a spec reads; optional layers and tables may lack them."""
    wanted: set[str] = set()

    def note(name: str) -> Column:
        wanted.add(name)
        return F.lit(None).cast("double")

    for _, build in spec.expand():
        build(note)
    return wanted


def calculate(frames: Mapping[str, DataFrame], specs: Sequence[CalcSpec]) -> dict[str, DataFrame]:
    """Calculated fields on every layer or table they belong to, where their inputs exist."""
    out = dict(frames)
    for name, df in out.items():
        known = set(df.columns)
        for spec in specs:
            if name in spec.tables and _inputs(spec) <= known:
                df = apply_calcs(df, name, [spec])
                known |= {n for n, _ in spec.expand()}
        out[name] = df
    return out


def members_joined(target: DataFrame, source: DataFrame, members: DataFrame, target_spec: FeatureSpec,
                   source_spec: FeatureSpec) -> DataFrame:
    """Source features once per target they lie in, with the target's own columns that the source lacks."""
    linked = members.select(target_spec.key, source_spec.key).join(source, source_spec.key)
    labels = [c for c in target.columns if c != target_spec.key and c not in source.columns]
    if not labels:
        return linked
    # One area may hold much of the features; who is hot is read from the membership alone.
    labelled = target.select(target_spec.key, *labels)
    return spread_join(linked, labelled, target_spec.key, advice=advise(members, labelled, target_spec.key))


def summarise_specs(specs: Sequence[SummarySpec], targets: DataFrame, source: DataFrame, members: DataFrame | None, year: int) -> list[DataFrame]:
    """All specs of one target and source in one membership join and one aggregation, over the target layer itself or the source features in it."""
    rows = targets if members is None else members_joined(targets, source, members, specs[0].target, specs[0].source)
    if "Year" not in rows.columns:
        rows = rows.withColumn("Year", F.lit(year))
    return summarize_all(rows, [Summary(s.group, s.aggs, s.consolidate, s.melt) for s in specs])


def region_references(areas: DataFrame, parcels: DataFrame) -> DataFrame:
    """Shares of the region and value indices; the region's sums are one row read by scalar subqueries."""
    sums = column_sums(parcels, rs.REGION_COLUMNS)
    known = attach_scalars(areas, sums, {f"__r_{c}": c for c in rs.REGION_COLUMNS})
    out = known.withColumns({
        **{n: divide(F.col(c), F.col(f"__r_{c}")) for n, c in rs.REGION_SHARES.items()},
        **{n: F.try_divide(divide(F.col(c), F.col("LND_SQFOOT")),
                           divide(F.col(f"__r_{c}"), F.col("__r_LND_SQFOOT"))) for n, c in rs.REGION_INDICES.items()},
    })
    return out.drop(*[f"__r_{c}" for c in rs.REGION_COLUMNS])


def snapshot(layers: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], members: Members, year: int | str,
             outputs: Sequence[str] | None = None,
             feature_specs: Sequence[FeatureSpec] = rs.LAYERS, table_specs: Sequence[TableSpec] = rs.TABLES,
             enrich: Sequence[SummarySpec] = rs.ENRICH, elongate: Sequence[SummarySpec] = rs.ELONGATE,
             modes: Sequence[str] = rs.MODES) -> dict[str, DataFrame]:
    """Report tables of one year: all, or the layers and long tables named in `outputs`.

    `members` maps (target layer, source layer) to rows of target key and source key.
    Summaries whose layers or membership are absent are left out. Only what the outputs
    need is planned. All summaries of one layer to another share one join and one aggregation.
    Layers read more than once, sizes and hot keys are worked out while planning.
    """
    def wanted(name: str) -> bool:
        return outputs is None or name in outputs

    number = int(PSEUDO_YEARS.get(year, year))
    area = rs.AREAS.name
    access_tables = {f"ActivityByTime_{m}": m for m in modes}
    from_areas = {s.out for s in elongate if s.source.name == area} | set(access_tables)
    enriched = {s.target.name for s in enrich if wanted(s.target.name)}
    if any(wanted(n) for n in from_areas):
        enriched.add(area)
    planned = [s for s in enrich if s.target.name in enriched]
    planned += [s for s in elongate if wanted(s.out)]
    used = {n for s in planned for n in (s.target.name, s.source.name)} | {n for n in layers if wanted(n)}
    if area in enriched:
        used.add(rs.PARCELS.name)

    joined = join_specs({n: df for n, df in layers.items() if n in used}, tables, feature_specs, table_specs)
    # A year column from another year's table must not reach the report.
    joined = {n: df.withColumn("Year", F.lit(number)) for n, df in joined.items()}
    base = calculate(joined, rs.PRECALCS)
    pairs: dict[tuple[str, str], list[SummarySpec]] = {}
    for spec in planned:
        pair = (spec.target.name, spec.source.name)
        if set(pair) <= set(base) and (pair in members or spec.target.name == spec.source.name):
            pairs.setdefault(pair, []).append(spec)
    # A layer that several pairs read is joined and calculated once, then read from where it was written.
    readers = Counter(source for target, source in pairs if source != target)
    readers.update(target for target, _ in pairs)
    readers.update([rs.PARCELS.name] if area in enriched and wanted(area) else [])
    base = {n: cut(df) if readers[n] > 1 else df for n, df in base.items()}
    out, longs = dict(base), {}
    group_labels = [g.name for g in rs.AREA_GROUP]
    for (target, source), specs in pairs.items():
        if target == source:
            continue
        # Sources are the layers before enrichment, so results do not depend on the order of the specs.
        labels = group_labels if any(s.out for s in specs) else [specs[0].target.key]
        made = summarise_specs(specs, base[target].select(*labels), base[source], members[target, source], number)
        for spec, table in zip(specs, made):
            if spec.out:
                longs[spec.out] = table
            else:
                out[target] = extend(out[target], table, spec.target.key, spec.target.key, append_only=False)
    for (target, source), specs in pairs.items():
        if target != source:
            continue

        def needs(s: SummarySpec) -> set[str]:
            return {i for c in s.consolidate for i in c.inputs} | set(s.melt.inputs if s.melt else ())

        own = [s for s in specs if s.out and needs(s) <= set(out[target].columns)]
        if own:
            if wanted(target):
                # The enriched layer is a result and the source of others.
                out[target] = cut(out[target])
            longs |= zip([s.out for s in own], summarise_specs(own, out[target], out[target], None, number))
    if area in out:
        known = set(out[area].columns)
        for name, mode in access_tables.items():
            if wanted(name) and {f"{a}{b}Min{mode[0]}" for a in rs.ACTIVITIES for b in TIME_BREAKS} <= known:
                longs[name] = long_access(out[area], list(rs.AREA_INDEX), rs.ACTIVITIES, TIME_BREAKS, mode, number)
    out = calculate({n: df for n, df in {**out, **longs}.items() if wanted(n)}, rs.CALCS)
    if area in out and area in enriched and rs.PARCELS.name in base:
        out[area] = region_references(out[area], base[rs.PARCELS.name])
    return out


def rename_keys(frames: Mapping[str, DataFrame], old: str = rs.FINAL_KEY[0], new: str = rs.FINAL_KEY[1]) -> dict[str, DataFrame]:
    """The area key under its final name in every table that has it."""
    return {n: df.withColumnRenamed(old, new) for n, df in frames.items()}


def trend(snapshots: Mapping[int | str, Mapping[str, DataFrame]], base: int | str | None = None,
          latest: int | str | None = None, diff_tables=rs.DIFF_TABLES, diff_features=rs.DIFF_FEATURES,
          long_features: Sequence[str] = rs.LONG_FEATURES) -> dict[str, DataFrame]:
    """Tables long on year (`_byYear`) and the difference of the latest to the base year (`_diff`)."""
    years = list(snapshots)
    base = years[0] if base is None else base
    latest = years[-1] if latest is None else latest
    if base not in years or latest not in years:
        raise ValueError("base and latest year must be among the snapshots")
    out: dict[str, DataFrame] = {}
    for name in [s.table for s in diff_tables] + list(long_features):
        frames = {y: snap[name] for y, snap in snapshots.items() if name in snap}
        if frames:
            out[f"{name}_byYear"] = stack_years(frames)
    for spec in diff_tables:
        if spec.table in snapshots[base] and spec.table in snapshots[latest]:
            out[f"{spec.table}_diff"] = difference(snapshots[latest][spec.table], snapshots[base][spec.table], spec.index)
    for spec in diff_features:
        if spec.table in snapshots[base] and spec.table in snapshots[latest]:
            out[f"{spec.table}_diff"] = feature_difference(
                snapshots[latest][spec.table], snapshots[base][spec.table], spec.index, spec.key)
    return out


def near_term_trend(current: Mapping[str, DataFrame], near_term: Mapping[str, DataFrame], current_year: int) -> dict[str, DataFrame]:
    """The same comparison from the current snapshot to the near-term one."""
    return trend({current_year: current, "NearTerm": near_term}, current_year, "NearTerm")

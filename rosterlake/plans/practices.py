"""Group practices and quarterly panels.

Directory frames: npi, date, group_id, org_name, group_size, state, zip,
phone. Registry locations: npi, quarter, plocstatename, ploczip, ploctel.
A blank phone is null; inside the directory a blank phone is an ordinary
value where phones identify (two blanks match), never a value to copy.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterlake import schemas as S
from rosterlake.functions.dates import quarter_start
from rosterlake.functions.text import group_location_id
from rosterlake.operators.impute import (backfill_periods, batch_fill, consistent_tuple,
                                         consistent_value, fill_beside, fill_from,
                                         fill_tuple_beside)
from rosterlake.operators.joins import (anti_join, count_copresent, join_group_stats,
                                        natural_join, provenance_join, semi_join,
                                        with_group_stats)
from rosterlake.operators.reshape import first_date_by_type, indicators, to_long, value_columns
from rosterlake.operators.rows import (frequent_values, last_non_null, quantile_bins,
                                       surrogate_id)
from rosterlake.session import cut

DIRECTORY = ["npi", "date", "org_name", "group_id", "group_size", "state", "zip", "phone"]


PERSON_ROWS = 100_000     # rows of a person up to which one task looks at them together


def infer_groups(directory: DataFrame, late_years: Sequence[int] = (2018, 2019, 2020),
                 person_rows: int = PERSON_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows with a group, rows without), after ten ordered fill passes.

    ``directory`` is already repaired. The first five kinds of pass look at
    one person at a time: rows are dealt by person once, and a pass is a sort
    there. Persons of many rows, around ``person_rows`` and more, take the same
    passes as aggregates joined back, which spread over tasks. The two eras are
    kept apart by an extra id instead of two copies of the data.
    """
    rows = directory.select(*DIRECTORY)
    late = F.coalesce(F.year("date").isin(list(late_years)), F.lit(False))
    large = cut(_large_persons(rows, person_rows))
    if large.isEmpty():
        rows = cut(_passes_beside(rows, late))
    else:
        far = cut(semi_join(rows.distinct().withColumn("__late", late), large, on=["npi"]))
        rows = cut(_passes_beside(anti_join(rows, large, on=["npi"]), late)
                   .unionByName(_passes_joined(far)))

    # a value that one place, date and phone has alone is the same before and
    # after rows there are filled from it, so one table serves all the rest
    # (keys that tell rows apart come first: a join sorts by them in this order)
    spot = ["phone", "zip", "date", "state"]
    sure = consistent_value(rows.where("__grouped"), spot, "group_id")
    rest = cut(fill_from(rows.where(F.col("group_id").isNull()), sure, spot))
    found = rest.where(F.col("group_id").isNotNull())
    listed = rows.where(F.col("group_id").isNotNull())
    # only rows beside a blank one can be met by a filled one
    beside = cut(listed.where("__open").unionByName(found).select(*DIRECTORY).distinct())
    return (listed.where("not __open").select(*DIRECTORY).unionByName(beside),
            rest.where(F.col("group_id").isNull()).select(*DIRECTORY))


def _large_persons(rows: DataFrame, person_rows: int, hashes: int = 4) -> DataFrame:
    """Persons who may have more than ``person_rows`` distinct rows.

    The least of n hashes is near 1 / n of their range, whatever comes twice,
    so the mean of its logarithm over a few hashes tells n to a small factor.
    From an eighth of the bound on a person counts as large: one beyond it is
    missed once in 10 ** 13.
    """
    rest = F.xxhash64(*[c for c in rows.columns if c != "npi"])
    # how many times a hash halves its range
    halved = [F.floor(-F.log2(F.xxhash64(rest, F.lit(i)) / F.lit(2.0 ** 64) + F.lit(0.5 + 2.0 ** -60)))
              for i in range(hashes)]
    most = [F.max(h.cast("tinyint")).alias(f"__most{i}") for i, h in enumerate(halved)]
    mean = reduce(lambda a, b: a + b, [F.col(f"__most{i}") for i in range(hashes)]) / F.lit(float(hashes))
    bound = math.log2(max(person_rows / 8, 1e-3)) + 0.33
    return rows.groupBy("npi").agg(*most).where(mean >= bound).select("npi")


_PLACE = ["npi", "state", "zip", "phone"]
_DETAILS = ["zip", "org_name", "group_size", "state", "phone"]
_SPOT = ["npi", "date", "state", "zip", "phone"]


def _passes_beside(rows: DataFrame, late: Column) -> DataFrame:
    """The passes within a person, for persons that fit one task: distinct rows,
    with whether the person has a group (``__grouped``; others stay as they are)
    and whether a row of the same date and place is without (``__open``).

    All keys begin with the person, so rows move once, as the person's set of
    rows (a distinct below that only takes copies away drops out of the plan);
    passes whose keys begin alike share a sort.
    """
    blank = F.col("group_id").isNull()
    rest = [c for c in DIRECTORY if c != "npi"]
    sets = rows.groupBy("npi").agg(F.collect_set(F.struct(*rest)).alias("__rows"))
    rows = sets.select("npi", F.inline("__rows")).withColumn("__late", late)
    rows = rows.sortWithinPartitions(*_PLACE)
    rows = rows.withColumn("__grouped", F.max(~blank).over(Window.partitionBy("npi")))
    rows = fill_beside(rows, _PLACE, ["group_id"], ["phone"])
    rows = rows.sortWithinPartitions("npi", "group_id", "__late")
    rows = fill_beside(rows, ["npi", "group_id"], _DETAILS)
    rows = fill_beside(rows, ["npi", "group_id", "__late"], _DETAILS)
    era = ["npi", "state", "zip", "__late"]
    rows = fill_beside(rows, [*era, "phone"], ["group_id"], ["phone"])
    rows = fill_tuple_beside(rows, era, ["org_name", "phone", "group_id"], F.col("__grouped"))
    rows = rows.drop("__late").distinct()
    return rows.withColumn("__open", F.max(blank).over(Window.partitionBy(*_SPOT)))


def _passes_joined(rows: DataFrame) -> DataFrame:
    """``_passes_beside`` for persons of any size."""
    blank = F.col("group_id").isNull()
    rows = cut(with_group_stats(rows, ["npi"], __grouped=F.max(~blank)))
    known = _person_passes(rows.where("__grouped"))
    rows = known.unionByName(rows.where("not __grouped")).drop("__late").distinct()
    return with_group_stats(cut(rows), _SPOT, __open=F.max(blank))


def _person_passes(rows: DataFrame) -> DataFrame:
    """The passes within a person, in order. Copies a pass makes do no harm
    to the next, so they are only folded at the end."""
    rows = _joined_fill(rows, _PLACE, ["group_id"], ["phone"])
    rows = _joined_fill(rows, ["npi", "group_id"], _DETAILS)
    rows = _joined_fill(rows, ["npi", "group_id", "__late"], _DETAILS)
    rows = _joined_fill(rows, [*_PLACE, "__late"], ["group_id"], ["phone"])
    return _joined_fill_tuple(rows, ["npi", "state", "zip", "__late"], ["org_name", "phone", "group_id"])


def _joined_fill(rows: DataFrame, ids: Sequence[str], targets: Sequence[str],
                 blank_ids: Sequence[str] = ()) -> DataFrame:
    return cut(batch_fill(rows, ids, targets, blank_ids, distinct=False, split=True))


def _joined_fill_tuple(rows: DataFrame, ids: Sequence[str], targets: Sequence[str]) -> DataFrame:
    return fill_from(rows, consistent_tuple(rows, ids, targets), ids, split=True)


def impute_groups(known: DataFrame, missing: DataFrame
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Own group ids by place and phone, or by person and place without a
    phone; members per date, by listed and by own group."""
    rows = known.unionByName(missing)
    by_phone = surrogate_id(
        rows.where(F.col("phone").isNotNull()).select("state", "zip", "phone").distinct(),
        ["state", "zip", "phone"], "my_group_id", S.ID_BY_PHONE_PLACE)
    by_person = surrogate_id(
        rows.where(F.col("phone").isNull()).select("npi", "state", "zip").distinct(),
        ["npi", "state", "zip"], "my_group_id", S.ID_BY_PERSON_PLACE)
    out = (join_group_stats(rows.where(F.col("phone").isNotNull()), by_phone,
                            ["phone", "zip", "state"], how="inner")
           .unionByName(join_group_stats(rows.where(F.col("phone").isNull()), by_person,
                                         ["npi", "state", "zip"], how="inner")))
    return (out, members_per(out, "group_id", "date", "num_group_members_GPPID_recalc"),
            members_per(out, "my_group_id", "date", "num_group_members_myid_recalc"))


def members_per(df: DataFrame, group: str, period: str, out: str,
                person: str = "npi") -> DataFrame:
    """Distinct persons per group and period; null groups make no row."""
    return (df.where(F.col(group).isNotNull() & F.col(period).isNotNull())
            .select(group, period, person).distinct()
            .groupBy(group, period).agg(F.count(F.lit(1)).alias(out)))


def directory_quarters(df: DataFrame, columns: Sequence[str],
                       backfill: Sequence[tuple[str, str]] = S.QUARTER_BACKFILL,
                       once: bool = False) -> DataFrame:
    """Distinct rows by quarter, with missing quarters copied from the next;
    with ``once`` a copy that equals a row of its new quarter is left out."""
    rows = df.withColumn("quarter", quarter_start("date")).select(*columns, "quarter")
    if once:
        return backfill_periods(rows, backfill).distinct()
    return backfill_periods(rows.distinct(), backfill)


def infer_all_groups(inferred: DataFrame, locations: DataFrame,
                     backfill: Sequence[tuple[str, str]] = S.QUARTER_BACKFILL
                     ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Group ids for directory and registry people at quarter grain.

    Returns (all rows, members per registry-based group, directory dates per
    person, all dates per person).
    """
    loc = locations.select("npi", "quarter", F.col("plocstatename").alias("state"),
                           F.col("ploczip").alias("zip"), F.col("ploctel").alias("phone"))
    loc = cut(loc.distinct())
    spot = ["phone", "zip", "quarter", "state"]
    places = surrogate_id(loc.select(*spot), ["quarter", "state", "zip", "phone"],
                          "my_group_id_npi", S.ID_BY_REGISTRY_PLACE, distinct=True)
    registry = join_group_stats(loc, places, spot, how="inner")
    members = members_per(registry, "my_group_id_npi", "quarter",
                          "num_group_members_myid_npi_recalc")

    cols = ["state", "zip", "phone", "group_id", "my_group_id", "npi"]
    base = cut(directory_quarters(inferred, cols, backfill, once=True))
    usable = F.col("phone").isNotNull() & F.col("state").isNotNull() & F.col("zip").isNotNull()
    own, targets = ["npi", *spot], ["group_id", "my_group_id"]
    ends = [f(c).alias(f"__{end}_{c}") for c in targets for f, end in ((F.min, "lo"), (F.max, "hi"))]

    def only(c: str) -> Column:
        return F.when(F.col(f"__lo_{c}") == F.col(f"__hi_{c}"), F.col(f"__hi_{c}"))

    # listed group and own id where a place has just one, beside its number
    alone = base.where(usable).groupBy(*spot).agg(*ends).select(
        *spot, *[only(c).alias(f"__any_{c}") for c in targets])
    seen = cut(join_group_stats(loc, join_group_stats(places, alone, spot), spot, how="inner"))

    # Blank phones of the two sources are different values. Both joins below
    # take the same columns, so each side moves once for them.
    blank = F.col("phone").isNull()
    key = [*own, "__blank"]
    listed = base.withColumn("__blank", F.when(blank, "directory").otherwise(""))
    known = seen.withColumn("__blank", F.when(blank, "registry").otherwise(""))
    known = known.withColumnsRenamed({c: f"__known_{c}" for c in key})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__known_{c}")) for c in key])
    # a registry row that no listed row meets takes what its place has alone
    both, is_listed = listed.join(known, same, "outer"), F.col("__blank").isNotNull()
    both = both.select(*[F.when(is_listed, F.col(c)).otherwise(
        F.col(f"__any_{c}" if c in targets else f"__known_{c}")).alias(c) for c in base.columns],
        "my_group_id_npi")

    # One that meets some takes that, or else what the person has alone there,
    # as a row of its own if none of them has it. A place's only value is the
    # only one of all who are there, so a value is that one if it is known.
    has = {c: F.col(c).isNotNull() for c in targets}
    as_known = {"__both": has["group_id"] & has["my_group_id"], "__group": has["group_id"] & ~has["my_group_id"],
                "__own": ~has["group_id"] & has["my_group_id"]}
    ends = [f(F.when(usable, F.col(c))).alias(f"__{end}_{c}") for c in targets
            for f, end in ((F.min, "lo"), (F.max, "hi"))]
    met = listed.join(known, same).groupBy(*own, "my_group_id_npi", *[f"__any_{c}" for c in targets]).agg(
        *ends, *[F.max(v).alias(n) for n, v in as_known.items()])
    met = met.withColumns({c: F.coalesce(F.col(f"__any_{c}"), only(c)) for c in targets})
    new = (F.when(as_known["__both"], ~F.col("__both")).when(as_known["__group"], ~F.col("__group"))
           .when(as_known["__own"], ~F.col("__own")))
    out = both.unionByName(met.where(new).select(*both.columns))

    def dates(df: DataFrame) -> DataFrame:
        return df.groupBy("npi").agg(F.min("quarter").alias("quarter_x"),
                                     F.max("quarter").alias("quarter_y"))

    # an outer join keeps every row of both sides and changes no person or
    # quarter, so the dates of ``out`` are those of its sides, without it
    sides = [df.select("npi", "quarter") for df in (base, loc)]
    return out, members, dates(base), dates(reduce(lambda a, b: a.unionByName(b), sides))


# Count columns per kind of group id.
GROUP_COUNTS = {"group_id": ("MDDO_gppid", "NP_gppid"), "my_group_id": ("MDDO_mgi", "NP_mgi"),
                "my_group_id_npi": ("MDDO_mginpi", "NP_mginpi")}


def role_counts(rows: DataFrame, types: DataFrame,
                groups: Mapping[str, tuple[str, str]] = GROUP_COUNTS,
                of: DataFrame | None = None) -> DataFrame:
    """Physicians and nurse practitioners per quarter, for each group id, beside
    all rows or only those of ``of``; all rows count either way.

    Rows move by person once, to meet their roles; a person is counted once per
    quarter and group where the roles were met, for all group ids together.
    """
    roles = types.groupBy("npi").agg(F.sum("MD/DO").alias("__md"), F.sum("NP").alias("__np"))
    # as in ``join_group_stats``, but the rows stay as they are dealt
    zero, key = F.pmod(F.xxhash64("npi"), F.lit(1)), ["npi", "__spread"]
    met = natural_join(rows.select("npi", "quarter", *groups).withColumn("__spread", zero),
                       roles.withColumn("__spread", zero), on=key, null_equal=False)
    kinds = {met.schema[g].dataType for g in groups}
    ids = {g: F.col(g) if len(kinds) == 1 else F.col(g).cast("string") for g in groups}
    pairs = F.array(*[F.struct(F.lit(i).alias("__kind"), c.alias("__group")) for i, c in enumerate(ids.values())])
    people = (met.select(*key, "quarter", F.inline(pairs), "__md", "__np")
              .where(F.col("__group").isNotNull()).distinct())
    counts = cut(people.groupBy("quarter", "__kind", "__group")
                 .agg(F.sum("__md").alias("__md"), F.sum("__np").alias("__np")))
    out = rows if of is None else of
    for i, (group, (md, np_)) in enumerate(groups.items()):
        per = counts.where(F.col("__kind") == i).select(
            "quarter", F.col("__group").cast(met.schema[group].dataType).alias(group),
            F.col("__md").alias(md), F.col("__np").alias(np_))
        out = join_group_stats(out, per, [group, "quarter"])
    return out


def physician_rows(rows: DataFrame, types: DataFrame, before: str = "2020-01-01") -> DataFrame:
    """Rows of physicians with a state, within the period. People counted as
    both kinds are not physicians here."""
    is_md = F.when(F.col("cat") == "both", 0).otherwise(F.col("MD/DO"))
    mds = types.where(is_md == 1).select("npi")
    return semi_join(rows.where((F.col("quarter") < F.lit(before).cast("date"))
                                & F.col("state").isNotNull()),
                     mds, on=["npi"], null_equal=False)


def largest_counts(counts: DataFrame) -> DataFrame:
    """Largest co-practice counts per person, quarter and state."""
    cols = [c for pair in GROUP_COUNTS.values() for c in pair]
    return counts.groupBy("npi", "quarter", "state").agg(*[F.max(c).alias(c) for c in cols])


def copractices(counts: DataFrame, types: DataFrame, before: str = "2020-01-01") -> DataFrame:
    """Largest co-practice counts per physician, quarter and state."""
    return largest_counts(physician_rows(counts, types, before))


def urban_classes(rows: DataFrame, final: DataFrame, urban: DataFrame,
                  four_digit: bool = True, classes: Sequence[int] = range(1, 7)) -> DataFrame:
    """Urban-class indicators per person, quarter and state, from 5-digit
    ZIPs; panel rows without any get them from 4-digit ZIPs.

    Classes are looked up per ZIP, by both lengths, as one bit per class and
    one for any; a panel row has the bits of its ZIPs.
    """
    key = ["npi", "quarter", "state"]
    names = {c: f"NCHSUR2013_{c}" for c in classes}
    bits = reduce(lambda a, b: a + b, [F.when(F.col("NCHSUR2013") == F.lit(c), F.lit(2 << i).cast("long"))
                                       .otherwise(F.lit(0)) for i, c in enumerate(names)], F.lit(1))
    zips = rows.select(F.substring("zip", 1, 5).alias("__z5")).distinct()
    zips = zips.withColumn("__z4", F.substring("__z5", 1, 4))
    for n in (5, 4):
        dim = (urban.where(F.col("NCHSUR2013").isNotNull())
               .groupBy(F.substring("ZCTA5", 1, n).alias(f"__z{n}")).agg(F.bit_or(bits).alias(f"__bits{n}")))
        zips = natural_join(zips, dim, "left", on=[f"__z{n}"], null_equal=False)
    placed = rows.select(*key, F.substring("zip", 1, 5).alias("__z5")).na.drop()
    placed = join_group_stats(placed, zips.select("__z5", "__bits5", "__bits4"), ["__z5"], "inner",
                              null_equal=False)
    found = placed.groupBy(*key).agg(F.bit_or("__bits5").alias("__bits5"),
                                     F.bit_or("__bits4").alias("__bits4"))
    mine = F.coalesce("__bits5", *["__bits4"] * four_digit, F.lit(0))
    wide = found.select(*key, *[mine.bitwiseAND(F.lit(2 << i)).cast("boolean").cast("int").alias(name)
                                for i, name in enumerate(names.values())])
    # a panel row without person, quarter or state has no place here
    return (natural_join(final, wide, "left", on=key, null_equal=False)
            .na.fill(0, list(names.values())))


def enrollment_dates(final: DataFrame, all_dates: DataFrame, enumeration: DataFrame,
                     codes_over_time: DataFrame
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Enumeration dates, date spans of the panel's people, and the first
    quarter each was more than a student."""
    people = final.select("npi").distinct()
    spans = semi_join(all_dates, people, on=["npi"], null_equal=False)
    working = semi_join(codes_over_time.where(F.col("ptaxcode") != S.STUDENT_CODE), people,
                        on=["npi"], null_equal=False)
    first = (working.groupBy("npi")
             .agg(F.min(quarter_start("month")).alias("quarter")))
    return enumeration, spans, first


def enrollee_locations(subset: DataFrame, state: DataFrame, zips: DataFrame, phones: DataFrame,
                       start: str = "2013-01-01", end: str = "2020-01-01") -> DataFrame:
    """Registry locations per person and quarter, within the period."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")

    def part(df: DataFrame, column: str) -> DataFrame:
        # a quarter starts on or after ``start`` exactly if its months do
        inside = df.where((F.col("month") >= quarter_start(lo)) & (F.col("month") < quarter_start(hi)))
        return inside.select("npi", "month", column)

    key = ["npi", "month"]
    # who is left out of one part is left out of all
    first = semi_join(part(state, "plocstatename"), subset.select("npi"), on=["npi"],
                      null_equal=False)
    out = natural_join(first, part(zips, "ploczip"), on=key, null_equal=False)
    out = natural_join(out, part(phones, "ploctel"), on=key, null_equal=False)
    return out.withColumn("quarter", quarter_start("month")).drop("month").distinct()


def reconcile_types(registry_types: DataFrame, creds: DataFrame, listed: DataFrame
                    ) -> tuple[DataFrame, DataFrame]:
    """(people, people with MD/DO, NP and cat) from registry and directory.

    Agreement of the sources decides; else the summed evidence with a known
    credential; else the larger sum; people with both credentials, or no
    majority, are "both".
    """
    mine = (registry_types.where((F.col("MD/DO") == 1) | (F.col("NP") == 1))
            .select("npi", F.col("MD/DO").alias("MDDO"), "NP"))
    cats = creds.where(F.col("cat").isin("MD/DO", "NP")).select("npi", "cat").distinct()
    cats = cats.groupBy("npi").agg(F.min("cat").alias("cat"), F.count(F.lit(1)).alias("n"))
    single = cats.where("n = 1").select("npi", "cat")
    two = cats.where("n > 1").select("npi")
    mine = natural_join(mine, single, "left", on=["npi"], null_equal=False)

    md = F.col("credential").isin("MD/DO", "MD", "DO")
    np_ = (F.col("primary_specialty") == "NURSE PRACTITIONER") | (F.col("credential") == "NP")
    theirs = (listed.groupBy("npi").agg(F.max(F.coalesce(md, F.lit(False)).cast("int")).alias("MDDO"),
                                        F.max(F.coalesce(np_, F.lit(False)).cast("int")).alias("NP"))
              .where("MDDO = 1 or NP = 1"))

    # agreeing rows collapse; the registry's category comes along with its row
    m = natural_join(mine, theirs, "outer", on=["npi", "MDDO", "NP"])
    per = m.groupBy("npi").agg(F.count(F.lit(1)).alias("n"), F.sum("MDDO").alias("md"),
                               F.sum("NP").alias("np"), F.max("cat").alias("row_cat"))
    per = natural_join(per, single.withColumnRenamed("cat", "known"), "left", on=["npi"],
                       null_equal=False)
    per = natural_join(per, two.withColumn("two", F.lit(True)), "left", on=["npi"],
                       null_equal=False)

    no = F.lit(False)
    clash = (((F.col("md") == 1) & (F.col("np") == 1))
             | F.coalesce((F.col("row_cat") == "NP") & (F.col("md") == 1), no)
             | F.coalesce((F.col("row_cat") == "MD/DO") & (F.col("np") == 1), no))
    plain = (F.col("n") == 1) & ~clash
    voted_md = (F.col("np") == 1) & F.col("md").isin(1, 2) & (F.col("known") == "MD/DO")
    voted_np = (F.col("md") == 1) & F.col("np").isin(1, 2) & (F.col("known") == "NP")
    cat = (F.when(plain, F.when(F.col("np") == 1, "NP").otherwise("MD/DO"))
           .when(F.coalesce(voted_md, no), "MD/DO").when(F.coalesce(voted_np, no), "NP")
           .when(F.coalesce(F.col("two"), no), "both")
           .when(F.col("md") > F.col("np"), "MD/DO").when(F.col("md") < F.col("np"), "NP")
           .otherwise("both"))
    out = per.select("npi", cat.alias("cat"))
    types = out.select("npi", F.when(F.col("cat") == "NP", 0).otherwise(1).alias("MD/DO"),
                       F.when(F.col("cat") == "MD/DO", 0).otherwise(1).alias("NP"), "cat")
    return types.select("npi"), types


def master_group_practices(known: DataFrame, start: str = "2013-01-01", end: str = "2020-01-01",
                           backfill: Sequence[tuple[str, str]] = S.QUARTER_BACKFILL) -> DataFrame:
    """Listed groups per person and quarter, back-filled, within the period."""
    out = directory_quarters(known, ["npi", "group_id", "state", "phone", "zip"], backfill)
    return out.where((F.col("quarter") >= quarter_start(F.lit(start).cast("date")))
                     & (F.col("quarter") < quarter_start(F.lit(end).cast("date"))))


def match_to_groups(locations: DataFrame, groups: DataFrame) -> DataFrame:
    """Every person's group ids per quarter, with a composite location id.

    A person listed with a group that quarter contributes both the registry's
    and the directory's location. Others get the groups of their location, or
    the location's own id.
    """
    loc = locations.select("npi", "quarter", F.col("plocstatename").alias("state"),
                           F.col("ploczip").alias("zip"), F.col("ploctel").alias("telephone"))
    # blank phones differ by source, so they are kept apart by their spelling
    loc = cut(loc.withColumn("telephone", F.coalesce("telephone", F.lit("NAN"))).distinct())
    listed = groups.select("npi", "quarter", "group_id", F.col("state").alias("d_state"),
                           F.col("zip").alias("d_zip"),
                           F.coalesce("phone", F.lit("nan")).alias("d_phone"))
    both = natural_join(loc, listed, on=["npi", "quarter"], null_equal=False)
    spots = F.array(
        F.struct("state", "zip", "telephone"),
        F.struct(F.col("d_state").alias("state"), F.col("d_zip").alias("zip"),
                 F.col("d_phone").alias("telephone")))
    have = cut(both.select("npi", "quarter", "group_id", F.explode(spots).alias("__s"))
               .select("npi", "quarter", "__s.*", "group_id").distinct())

    spot = ["state", "zip", "telephone", "quarter"]
    numbered = surrogate_id(loc.select(*spot).na.drop().distinct(), spot, "npi_group_id",
                            S.ID_BY_LOCATION)
    at_spot = have.select(*spot, "group_id").distinct()
    known = provenance_join(numbered, at_spot, on=spot, how="left")
    by_place = known.select(*spot, F.when(F.col("_merge") == "both", F.col("group_id"))
                            .otherwise(F.col("npi_group_id")).alias("group_id")).distinct()
    rest = anti_join(loc, have.select("npi", "quarter").distinct(), on=["npi", "quarter"],
                     null_equal=False)
    added = join_group_stats(rest, by_place, spot, how="inner")
    out = have.unionByName(added.select(*have.columns)).distinct()
    return out.withColumn("group_quarter_loc_id", group_location_id(
        "group_id", "quarter", "state", "zip", "telephone"))


def colocated_nps(members: DataFrame) -> DataFrame:
    """Distinct nurse practitioners sharing a group location with each
    physician, per quarter. Members: npi, quarter, group_quarter_loc_id,
    MD/DO, NP."""
    return count_copresent(members, "npi", ["group_quarter_loc_id"], ["quarter"],
                           F.col("MD/DO") == 1, F.col("NP") == 1, "npcount")


def np_counts_for_mds(location_quarters: DataFrame, members: DataFrame,
                      types: DataFrame) -> DataFrame:
    """Co-located nurse practitioners for every physician-quarter, 0 if none."""
    mds = types.where(F.col("MD/DO") == 1).drop("MD/DO", "NP")
    rows = natural_join(location_quarters.select("npi", "quarter").distinct(), mds, on=["npi"],
                        null_equal=False)
    out = natural_join(rows, colocated_nps(members), "left", on=["npi", "quarter"],
                       null_equal=False)
    return out.withColumn("npcount", F.coalesce("npcount", F.lit(0)).cast("int"))


def np_counts_master(locations: DataFrame, known: DataFrame, types: DataFrame,
                     **period: str) -> DataFrame:
    """From locations, listed groups and types to counts per physician-quarter."""
    full = match_to_groups(locations, master_group_practices(known, **period))
    # counted from in several reads, each of which would match the groups anew
    members = cut(natural_join(full.select("npi", "quarter", "group_quarter_loc_id").distinct(),
                               types, on=["npi"], null_equal=False))
    return np_counts_for_mds(locations.select("npi", "quarter").distinct(), members, types)


# ------------------------------------------------------------ analysis panels

def sole_practices(directory: DataFrame, details: Sequence[str] = ("org_name", "phone")
                   ) -> DataFrame:
    """Every row gets a group: rows without one a single-row id, and a size
    from the recounted members where none is listed. ``details`` are the
    columns kept beside group, size and place; the ids are by all of them."""
    cols = ["npi", "date", "group_id", "group_size", "org_name", "state", "zip", "phone"]
    kept = [c for c in cols if c in details or c not in ("org_name", "phone")]
    own = [c for c in cols if c != "group_id"]
    alone = surrogate_id(directory.where(F.col("group_id").isNull()).select(own).distinct(), own,
                         "group_id", S.ID_BY_PHONE_PLACE)
    listed = directory.where(F.col("group_id").isNotNull()).select(kept).distinct()
    rows = cut(listed.unionByName(alone.select(kept)))
    # every group and date has a count, but only rows without a size need it
    open_, dated = F.col("group_size").isNull(), F.col("date").isNotNull()
    people = rows.where(dated).groupBy("group_id", "date", "npi").agg(F.max(open_).alias("__open"))
    size = (people.groupBy("group_id", "date")
            .agg(F.count(F.lit(1)).alias("__size"), F.max("__open").alias("__open"))
            .where("__open").drop("__open"))
    out = join_group_stats(rows.where(open_), size, ["group_id", "date"], how="inner")
    out = out.withColumn("group_size", F.coalesce("group_size", "__size")).drop("__size")
    return rows.where(~open_ & dated).unionByName(out)


def specialties(directory: DataFrame, mds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first primary specialty, distinct secondary specialties) per
    physician and date."""
    cols = [f"secondary_specialty_{i}" for i in range(1, 5)]
    # both results read the directory's rows, written once with what they need
    rows = cut(semi_join(directory.select("npi", "date", "primary_specialty", *cols), mds,
                         on=["npi"], null_equal=False))
    primary = last_non_null(rows, ["npi", "date"], [], ["primary_specialty"], first=True)
    secondary = (to_long(rows.select("npi", "date", *cols).distinct(), ["npi", "date"], cols,
                         "__slot", "secondary_spec")
                 .where("secondary_spec <> ' '").select("npi", "date", "secondary_spec").distinct())
    return primary, secondary


def waiver_dates(people: DataFrame, crosswalk: DataFrame, by: Sequence[str] = ("npi",)) -> DataFrame:
    """First date per waiver limit of each linked person, one column each."""
    rows = natural_join(people, crosswalk, on=["samhsa_id"], null_equal=False)
    return first_date_by_type(rows, list(by), "WaiverType", "Date", S.WAIVER_LIMITS)


def extreme_practices(groups: DataFrame, mds: DataFrame, nps: DataFrame) -> DataFrame:
    """Per physician and date: the listed location with the fewest and the one
    with the most nurse practitioners (``_min`` / ``_max`` columns)."""
    place = ["group_id", "group_size", "state", "zip", "date"]
    # read by several; rows that come twice change no count and no extreme below
    rows = cut(groups.select("npi", *place))
    pid = "group_prac_zip_date_id"
    numbered = surrogate_id(rows.select(*place), place, pid, distinct=True)
    # places are counted as they are, so only the physicians' rows meet the ids
    there = semi_join(rows, nps, on=["npi"], null_equal=False).where(F.col("date").isNotNull())
    counts = there.distinct().groupBy(*place).agg(F.count(F.lit(1)).alias("np_count"))
    seen = semi_join(rows, mds, on=["npi"], null_equal=False)
    seen = join_group_stats(seen, numbered, place, how="inner")
    seen = join_group_stats(seen, counts, place).na.fill(0, ["np_count"])
    carried = [pid, "group_id", "group_size", "state", "zip"]
    packed = F.struct("np_count", *carried)
    ends = seen.groupBy("npi", "date").agg(F.min(packed).alias("lo"), F.max(packed).alias("hi"))
    return ends.select("npi", "date", *[F.col(f"{side}.{c}").alias(f"{c}_{name}")
                                        for side, name in (("lo", "min"), ("hi", "max"))
                                        for c in ["np_count", *carried]])


def _column(name: str) -> Column:
    """A column by its exact name, whatever characters a value brought in."""
    return F.col("`" + name.replace("`", "``") + "`")


def analysis_dataset(directory: DataFrame, mds: DataFrame, nps: DataFrame, genders: DataFrame,
                     people: DataFrame, crosswalk: DataFrame,
                     secondary_values: Mapping[str, str] | None = None,
                     bins: int = 20) -> DataFrame:
    """Physician-date panel: extreme practices, specialties, education,
    gender and waiver dates. Secondary specialties become columns: all that
    occur, or those of ``secondary_values`` under the names given there."""
    out = extreme_practices(sole_practices(directory, details=()), mds, nps)
    primary, secondary = specialties(directory, mds)
    if secondary_values is None:
        secondary_values = value_columns(secondary, "secondary_spec")
    out = natural_join(out, primary, on=["npi", "date"], null_equal=False)
    if secondary_values:
        flags = indicators(secondary, ["npi", "date"], "secondary_spec", secondary_values)
        out = natural_join(out, flags, "left", on=["npi", "date"], null_equal=False)
        named = set(secondary_values.values())
        out = out.select(*[F.coalesce(_column(c), F.lit(0)).alias(c) if c in named else _column(c)
                           for c in out.columns])
    years = last_non_null(directory, ["npi"], ["date"], ["graduation_year"], first=True)
    out = cut(natural_join(out, years, on=["npi"], null_equal=False))
    out = quantile_bins(out, "graduation_year", bins, "gradyear").drop("graduation_year")
    out = natural_join(out, genders, on=["npi"], null_equal=False)
    return natural_join(out, waiver_dates(people, crosswalk), "left", on=["npi"],
                        null_equal=False)


def long_specialties(directory: DataFrame, codes: DataFrame, taxonomy: DataFrame,
                     people: DataFrame) -> DataFrame:
    """Every specialty of the panel's people, from directory and taxonomy, in
    one spelling."""
    cols = ["primary_specialty", *[f"secondary_specialty_{i}" for i in range(1, 5)]]
    who = people.select("npi")
    # a person's values of a column are few; sets of them are narrowed to the panel
    sets = directory.groupBy("npi").agg(*[F.collect_set(F.nullif(c, F.lit(" "))).alias(c) for c in cols])
    sets = semi_join(sets, who, on=["npi"], null_equal=False)
    listed = sets.select("npi", F.explode(F.array_distinct(F.flatten(F.array(*cols)))).alias("spec"))
    dim = taxonomy.select(F.col("TaxonomyCode").alias("ptaxcode"), "Classification",
                          "Specialization")
    tax = natural_join(semi_join(codes.select("npi", "ptaxcode"), who, on=["npi"], null_equal=False),
                       dim, on=["ptaxcode"], null_equal=False)
    general = F.coalesce(F.col("Specialization") == "General Practice", F.lit(False))
    tax = (to_long(tax.withColumn("__general", general), ["npi", "__general"],
                   ["Classification", "Specialization"], "__from", "spec")
           .withColumn("spec", F.upper("spec")))
    tax = tax.withColumn("spec", F.when(F.col("spec").endswith(" -"), F.replace(
        "spec", F.lit(" -"), F.lit(""))).otherwise(F.col("spec")))
    tax = tax.where(~(F.col("__general") & (F.col("spec") == "GENERAL PRACTICE")))
    fixed = F.when(F.col("spec") == "PREVENTATIVE MEDICINE", "PREVENTIVE MEDICINE").otherwise(
        F.col("spec"))
    both = listed.unionByName(tax.select("npi", "spec")).distinct()
    return both.withColumn("spec", F.trim(fixed))


def frequent_specialties(specialties_long: DataFrame, more_than: int = 500) -> DataFrame:
    """Rows of specialties held more than ``more_than`` times."""
    return frequent_values(specialties_long, "spec", more_than)


def specialty_indicators(specialties_long: DataFrame, people: DataFrame,
                         values: Mapping[str, str] | None = None) -> DataFrame:
    """One count per specialty for everyone in the panel, 0 for who has none:
    a column for every value, or for those of ``values`` as named there."""
    if values is None:
        values = value_columns(specialties_long, "spec")
    rows = natural_join(people.select("npi").distinct(), specialties_long.select("npi", "spec"),
                        "left", on=["npi"], null_equal=False)
    return indicators(rows, ["npi"], "spec", values, count=True)


def panel_specialties(directory: DataFrame, codes: DataFrame, taxonomy: DataFrame,
                      people: DataFrame, more_than: int = 500) -> tuple[DataFrame, DataFrame]:
    """(every specialty of the panel's people, one column per specialty held
    more than ``more_than`` times)."""
    every = cut(long_specialties(directory, codes, taxonomy, people))
    return every, specialty_indicators(frequent_specialties(every, more_than), people)


def listed_and_registered(listed: DataFrame, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(physicians, nurse practitioners): ids of the directory that say so
    there or in the registry. Directory: npi, Credential, primary_specialty;
    registry: npi, PractitionerType. An id may be both."""
    rows = natural_join(listed.select("npi", "Credential", "primary_specialty").distinct(),
                        types.select("npi", "PractitionerType").distinct(), "left", on=["npi"],
                        null_equal=False)
    # fixed values
    physician = F.col("Credential").isin("MD/DO", "MD", "DO") | (F.col("PractitionerType") == "MD/DO")
    nurse = ((F.col("primary_specialty") == "NURSE PRACTITIONER") | (F.col("Credential") == "NP")
             | (F.col("PractitionerType") == "NP"))
    return tuple(rows.where(who).select("npi").distinct() for who in (physician, nurse))


def final_analysis(final: DataFrame, education: DataFrame, genders: DataFrame,
                   people: DataFrame, crosswalk: DataFrame, bins: int = 20) -> DataFrame:
    """The co-practice panel with education, gender and waivers by state."""
    first = last_non_null(education, ["npi"], [], ["medical_school", "graduation_year"], first=True)
    first = quantile_bins(cut(first), "graduation_year", bins, "gradyear")
    out = natural_join(final, first, "left", on=["npi"], null_equal=False)
    out = natural_join(out, genders, on=["npi"], null_equal=False)
    waivers = waiver_dates(people.select("samhsa_id", "WaiverType", "Date",
                                         F.col("State").alias("state")).distinct(),
                           crosswalk, by=["npi", "state"])
    return natural_join(out, waivers, "left", on=["npi", "state"])


def waiver_analysis(directory: DataFrame, registry_types: DataFrame, creds: DataFrame,
                    listed_types: DataFrame, state: DataFrame, zips: DataFrame,
                    phones: DataFrame, urban: DataFrame, education: DataFrame,
                    genders: DataFrame, people: DataFrame, crosswalk: DataFrame,
                    enumeration: DataFrame, codes_over_time: DataFrame,
                    specialty_rows: DataFrame, taxonomy: DataFrame,
                    bins: int = 20, more_than: int = 500, **period: str) -> dict[str, DataFrame]:
    """The whole panel: groups, types, locations, counts, urban classes, and
    the specialties of its people, long and as columns.

    ``specialty_rows``: npi, primary_specialty, secondary_specialty_1 to 4.
    """
    inferred, by_listed, by_own = impute_groups(*infer_groups(directory))
    subset, types = reconcile_types(registry_types, creds, listed_types)
    types = cut(types)
    locations = enrollee_locations(types.select("npi"), state, zips, phones, **period)
    rows, by_registry, directory_dates, all_dates = infer_all_groups(inferred, locations)
    rows = cut(rows.drop("phone"))
    # all rows are counted, but only physicians' rows take the counts along, and
    # the panel has no other places
    theirs = cut(physician_rows(rows, types))
    final = largest_counts(role_counts(rows, types, of=theirs.drop("zip")))
    final = cut(final_analysis(final, education, genders, people, crosswalk, bins))
    long, wide = panel_specialties(specialty_rows, codes_over_time, taxonomy,
                                   final.select("npi").distinct(), more_than)
    enumerated, spans, first = enrollment_dates(final, all_dates, enumeration, codes_over_time)
    return {"final": urban_classes(theirs, final, urban), "specialties": long,
            "specializations": wide, "enumeration": enumerated,
            "spans": spans, "first_working_quarter": first,
            "members_by_listed_group": by_listed, "members_by_own_group": by_own,
            "members_by_registry_group": by_registry, "directory_dates": directory_dates}

"""Attributes of registered providers, from long monthly panels.

A panel frame has ``npi``, ``month``, maybe ``seq``, and one value column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake import schemas as S
from rosterlake.functions.text import credential_key, drop_chars, registry_phone
from rosterlake.operators.impute import purge_nulls
from rosterlake.operators.joins import (anti_join, at_or_after, nearest_month, natural_join,
                                        natural_join_all, semi_join, valid_until)
from rosterlake.operators.quality import null_count
from rosterlake.operators.reshape import (indicators, indicators_to_long, numbered_columns,
                                          split_to_rows)
from rosterlake.operators.rows import (first_row, last_non_null, only_repeated,
                                       surrogate_id)


def normalize_entities(entities: int | Sequence[int]) -> list[int]:
    chosen = sorted({entities} if isinstance(entities, int) else set(entities))
    if chosen not in ([1], [2], [1, 2]):
        raise ValueError(f"{entities!r} is not a valid choice of entity types")
    return chosen


def of_entity(df: DataFrame, entity: DataFrame, entities: int | Sequence[int]) -> DataFrame:
    """Rows of the chosen entity types; both types means no filter."""
    chosen = normalize_entities(entities)
    if chosen == [1, 2]:
        return df
    return semi_join(df, entity.where(F.col("entity") == chosen[0]).select("npi"),
                     on=["npi"], null_equal=False)


def entity_types(panel: DataFrame) -> DataFrame:
    return panel.select("npi", F.col("entity").cast("int").alias("entity")).na.drop().distinct()


def latest_date(panel: DataFrame, date: str) -> DataFrame:
    """Latest date per id (deactivation, reactivation)."""
    return (panel.where(F.col(date).isNotNull() & F.col("npi").isNotNull())
            .groupBy("npi").agg(F.max(F.col(date).cast("date")).alias(date)))


def removals(deact: DataFrame, react: DataFrame, entity: DataFrame | None = None,
             entities: int | Sequence[int] = (1, 2)) -> DataFrame:
    """Deactivated and not reactivated on or after that date."""
    back = at_or_after(deact, react, "npi", "npireactdate", "npideactdate")
    gone = anti_join(deact, back.select("npi"), on=["npi"], null_equal=False)
    return gone if entity is None else of_entity(gone, entity, entities)


def legal_name_part(panel: DataFrame, entity: DataFrame, part: str) -> DataFrame:
    """Every upper-cased value of a legal name part; a null only where the
    person never has one."""
    values = panel.select("npi", F.upper(part).alias(part)).distinct()
    out = purge_nulls(of_entity(values, entity, 1), part, ["npi"])
    return out.withColumn(part, drop_chars(part, ".")) if "suffix" in part else out


def other_name_part(panel: DataFrame, entity: DataFrame, part: str) -> DataFrame:
    """Every upper-cased value of an alternate name part."""
    values = panel.where(F.col(part).isNotNull())
    out = of_entity(values.select("npi", F.upper(part).alias(part)).distinct(), entity, 1)
    return out.withColumn(part, drop_chars(part, ".")) if "suffix" in part else out


def gender(panel: DataFrame, entity: DataFrame) -> DataFrame:
    """Last recorded gender."""
    up = panel.withColumn("pgender", F.upper("pgender"))
    return of_entity(last_non_null(up, ["npi"], ["month"], ["pgender"]), entity, 1)


def enumeration_dates(panel: DataFrame) -> DataFrame:
    return panel.select("npi", "penumdate").na.drop().distinct()


def credential_parts(panel: DataFrame, entity: DataFrame, column: str) -> DataFrame:
    """Single credentials: upper case, no periods, one row per comma part."""
    up = (panel.where(F.col(column).isNotNull())
          .select("npi", drop_chars(F.upper(column), ".").alias(column)).distinct())
    return split_to_rows(of_entity(up, entity, 1), column, ",").distinct()


def credential_map(spark: SparkSession) -> DataFrame:
    rows = [(c, cat) for cat, creds in S.CREDENTIALS.items() for c in creds]
    return spark.createDataFrame(rows, "credential string, cat string")


def credentials(own: DataFrame, other: DataFrame) -> DataFrame:
    """Both credential columns together, with category where known."""
    both = own.unionByName(other.withColumnRenamed("pcredentialoth", "pcredential")).distinct()
    keyed = both.withColumn("pcredential_stripped", credential_key("pcredential"))
    # the map is a fixed table of a few dozen rows
    cmap = F.broadcast(credential_map(own.sparkSession)
                       .withColumnRenamed("credential", "pcredential_stripped"))
    return keyed.join(cmap, "pcredential_stripped", "left").select(
        "npi", "pcredential", "pcredential_stripped", "cat")


def taxonomy_codes(panel: DataFrame, entity: DataFrame, entities: int | Sequence[int] = (1, 2),
                   taxonomy: DataFrame | None = None, temporal: bool = False) -> DataFrame:
    """Taxonomy codes per id, with taxonomy details when the dimension is
    given; codes the dimension lacks drop out then."""
    chosen = normalize_entities(entities)
    if temporal:
        out = natural_join(panel, entity.where(F.col("entity").isin(chosen)), on=["npi"],
                           null_equal=False)
        return out if chosen == [1, 2] else out.drop("entity")
    codes = panel.select("npi", "ptaxcode").distinct()
    out = natural_join(codes, entity.where(F.col("entity").isin(chosen)), on=["npi"],
                       null_equal=False)
    if taxonomy is not None:
        out = natural_join(out, taxonomy.withColumnRenamed("TaxonomyCode", "ptaxcode"),
                           on=["ptaxcode"], null_equal=False)
    return out if chosen == [1, 2] else out.drop("entity")


def code_categories(taxonomy: DataFrame) -> DataFrame:
    """Category of each taxonomy code that has one. Later rules win."""
    kind, cls, code = F.col("Type"), F.col("Classification"), F.col("TaxonomyCode")
    nursing = kind.isin(S.NURSING_TYPES)
    by_class = {cat: cls == name for name, cat in S.CLASSIFICATION_CATEGORIES.items()}
    rules = [("PA", by_class["PA"]), ("NP", by_class["NP"]),
             ("MD/DO", kind == S.PHYSICIAN_TYPE), ("CRNA", by_class["CRNA"]),
             ("CNM", by_class["CNM"]), ("CNS", by_class["CNS"]),
             ("RN", nursing & (cls == S.REGISTERED_NURSE)),
             ("LPN/LVN", nursing & cls.isin(S.PRACTICAL_NURSE)),
             ("Other Nurse", nursing & ~cls.isin(S.REGISTERED_NURSE, *S.PRACTICAL_NURSE)),
             ("Other APRN", code == S.OTHER_APRN_CODE)]
    rules += [(c, by_class[c]) for c in ("Chiropractor", "Dentist", "Podiatrist",
                                         "Pharmacist", "Optometrist", "Psychologist")]
    rules.append(("Student", code == S.STUDENT_CODE))
    cat: Column = F.lit(None).cast("string")
    for name, test in rules:
        cat = F.when(test, name).otherwise(cat)
    return (taxonomy.select(code.alias("ptaxcode"), cat.alias("cat"))
            .where(F.col("cat").isNotNull()).distinct())


def categorized_codes(codes: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Codes of persons with their category (null where none applies)."""
    return natural_join(codes, code_categories(taxonomy), "left", on=["ptaxcode"],
                        null_equal=False)


def practitioner_types(creds: DataFrame, codes: DataFrame) -> DataFrame:
    """One 0/1 column per type, from credential and taxonomy categories.

    Student and No Category are cleared where any real type is found. Both
    sources feed one aggregate.
    """
    cats = creds.select("npi", "cat").unionByName(codes.select("npi", "cat"))
    cats = cats.withColumn("cat", F.coalesce("cat", F.lit("No Category")))
    wide = indicators(cats, ["npi"], "cat", {t: t for t in S.PRACTITIONER_TYPES})
    weak = ["Student", "No Category"]
    real = F.greatest(*[F.col(t) for t in S.PRACTITIONER_TYPES if t not in weak])
    return wide.withColumns({t: F.when(real == 1, 0).otherwise(F.col(t)) for t in weak})


def practitioner_types_long(wide: DataFrame, types: Sequence[str] = ("MD/DO", "NP", "PA"),
                            name: str = "PractitionerType") -> DataFrame:
    return indicators_to_long(wide, ["npi"], list(types), name)


def licences(state: DataFrame, number: DataFrame, removed: DataFrame) -> DataFrame:
    """Licence number and state pairs held while active."""
    a, b = (valid_until(p, removed) for p in (state, number))
    both = natural_join(a, b, "outer", on=["npi", "month", "seq"])
    return both.select("npi", "PLICNUM", "PLICSTATE").distinct()


def address_part(panel: DataFrame, entity: DataFrame, removed: DataFrame, column: str,
                 entities: int | Sequence[int] = (1, 2)) -> DataFrame:
    """A location column over time: upper case, phones cleaned, active months."""
    value = registry_phone(column) if column.endswith("tel") else F.upper(column)
    rows = of_entity(panel.withColumn(column, value), entity, entities)
    return valid_until(rows, removed)


def secondary_locations(parts: Sequence[DataFrame]) -> DataFrame:
    return natural_join_all(parts)


def likely_doctors(creds: DataFrame, codes: DataFrame) -> DataFrame:
    """MD or DO by credential, or by taxonomy category."""
    a = creds.where(F.col("pcredential_stripped").isin("MD", "DO")).select("npi")
    b = codes.where(F.col("cat").isin("MD/DO", "MD/DO Student")).select("npi")
    return a.unionByName(b).distinct()


def credential_classification_pairs(creds: DataFrame, codes: DataFrame, taxonomy: DataFrame,
                                    credential: str | None = None,
                                    classification: str | None = None) -> DataFrame:
    """Credentials seen with a classification, or the other way round, counted."""
    if (credential is None) == (classification is None):
        raise ValueError("give either a credential or a classification")
    dim = taxonomy.select(F.col("TaxonomyCode").alias("ptaxcode"), "Classification")
    codes = codes.select("npi", "ptaxcode")
    if classification is not None:
        who = natural_join(codes, dim.where(F.col("Classification") == classification),
                           on=["ptaxcode"], null_equal=False).select("npi").distinct()
        found = natural_join(creds.select("npi", "pcredential_stripped"), who,
                             on=["npi"], null_equal=False)
        by = "pcredential_stripped"
    else:
        who = (creds.where(F.col("pcredential_stripped") == credential)
               .select("npi").distinct())
        found = natural_join(natural_join(codes, who, on=["npi"], null_equal=False), dim,
                             on=["ptaxcode"], null_equal=False)
        by = "Classification"
    return found.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def other_id_rows(ids: DataFrame, states: DataFrame, kinds: DataFrame) -> DataFrame:
    """Other identifiers with issuing state and type, per (npi, month, seq)."""
    key = ["npi", "month", "seq"]
    return natural_join(natural_join(ids, states, "left", on=key), kinds, "left", on=key)


def medicaid_providers(other_ids: DataFrame, single: Sequence[DataFrame], lic_state: DataFrame,
                       lic_number: DataFrame, codes: DataFrame,
                       state: str | None = None) -> dict[str, DataFrame]:
    """Everything held on providers with a Medicaid id (type 5), in a state if
    one is named: ids, single-valued attributes, licences, taxonomy codes."""
    hit = F.col("OTHPIDTY") == 5
    if state:
        hit = hit & (F.col("OTHPIDST") == state)
    who = other_ids.where(hit).select("npi").distinct()

    def keep(df: DataFrame) -> DataFrame:
        return semi_join(df, who, on=["npi"], null_equal=False)

    attributes = reduce(lambda a, b: natural_join(a, b, "outer", on=["npi", "month"]),
                        [keep(d) for d in single])
    licence = natural_join(keep(lic_state), keep(lic_number), "outer",
                           on=["npi", "month", "seq"])
    return {"other_ids": keep(other_ids), "attributes": attributes,
            "licences": licence, "taxonomy": keep(codes)}


def last_observed(panel: DataFrame, columns: Sequence[str], key: str = "npi",
                  time: str = "month") -> DataFrame:
    """Last non-null value of each column per id."""
    return last_non_null(panel, [key], [time], columns)


def removals_report(removed: DataFrame, types: DataFrame, creds: DataFrame,
                    last_state: DataFrame, names: DataFrame,
                    activity: DataFrame | None = None,
                    of_types: Sequence[str] = ("MD/DO", "CNM", "CNS", "CRNA", "NP",
                                               "Other APRN", "PA", "RN", "LPN/LVN",
                                               "Other Nurse", "Student"),
                    latest: int | None = 60) -> DataFrame:
    """Who left lately: removals of medical staff with credentials, last
    state, names and Medicare activity; ``latest`` most recent rows."""
    any_type = reduce(lambda a, b: a | b, [F.col(t) == 1 for t in of_types])
    out = semi_join(removed, types.where(any_type).select("npi"), on=["npi"], null_equal=False)
    for part in (creds.drop("pcredential_stripped"), last_state, names):
        out = natural_join(out, part, on=["npi"], null_equal=False)
    if activity is not None:
        out = natural_join(out, activity, "left", on=["npi"], null_equal=False)
    if latest is not None:
        rest = [c for c in out.columns if c not in ("npideactdate", "npi")]
        order = [F.desc("npideactdate"), F.desc("npi"), *[F.desc(c) for c in rest]]
        out = out.orderBy(*order).limit(latest)
    return out


def latest_phone(panel: DataFrame) -> DataFrame:
    """The phone of the last month observed."""
    return first_row(panel.select("npi", "month", "ploctel"), ["npi"], ["month"], last=True)


def detailed_codes(codes: DataFrame) -> DataFrame:
    """Taxonomy rows without those that only repeat a type and classification
    without a specialization."""
    key = ["npi", "Type", "Classification"]
    vague = only_repeated(codes, key).where(F.col("Specialization").isNull())
    return anti_join(codes, vague.select(*codes.columns))


def numbered_codes(codes: DataFrame, width: int) -> DataFrame:
    """Taxonomies side by side: ``ptaxcode1, Type1, ... ptaxcode2, ...``."""
    cols = ["ptaxcode", "Type", "Classification", "Specialization"]
    return numbered_columns(codes, ["npi"], cols, width)


def practice_locations(addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(addresses shared with another row, numbered distinct locations)."""
    place = ["ploctel", "zip", "plocstatename"]
    cols = ["plocline1", "plocline2", "ploccityname", "plocstatename", "ploczip", "ploctel"]
    rows = addresses.withColumn("zip", F.substring("ploczip", 1, 5))
    people = rows.select("npi", *cols, "zip").distinct().where(null_count([*cols, "zip"]) != 6)
    shared = only_repeated(people, place)
    numbered = surrogate_id(people.select(*place).distinct(), place, "location_no")
    return shared, numbered


def nearest_location(addresses: DataFrame, numbered: DataFrame,
                     dates: DataFrame) -> DataFrame:
    """Location number observed nearest in time to each person's date."""
    place = ["ploctel", "zip", "plocstatename"]
    rows = addresses.withColumn("zip", F.substring("ploczip", 1, 5))
    rows = natural_join(rows.select("npi", "month", *place).distinct(), numbered, on=place)
    near = nearest_month(dates, rows.select("npi", "month", "location_no").distinct(),
                         "npi", "Date", "month")
    return near.select("npi", "Date", "location_no").distinct()


class Registry:
    """Named lazy frames over a folder of panels, one dataset per variable."""

    def __init__(self, spark: SparkSession, root: str, taxonomy: DataFrame,
                 npis: DataFrame | None = None, entities: int | Sequence[int] = (1, 2)):
        self.spark, self.root, self.taxonomy, self.npis = spark, root, taxonomy, npis
        self.entities = normalize_entities(entities)

    def panel(self, variable: str) -> DataFrame:
        from rosterlake.sources.panels import read_panel
        return read_panel(self.spark, self.root, variable, self.npis)

    def entity(self) -> DataFrame:
        return entity_types(self.panel("entity"))

    def removaldate(self) -> DataFrame:
        return removals(latest_date(self.panel("npideactdate"), "npideactdate"),
                        latest_date(self.panel("npireactdate"), "npireactdate"),
                        self.entity(), self.entities)

    def credentials(self) -> DataFrame:
        e = self.entity()
        return credentials(credential_parts(self.panel("pcredential"), e, "pcredential"),
                           credential_parts(self.panel("pcredentialoth"), e, "pcredentialoth"))

    def ptaxcode(self, temporal: bool = False) -> DataFrame:
        return taxonomy_codes(self.panel("ptaxcode"), self.entity(), self.entities,
                              None if temporal else self.taxonomy, temporal)

    def practitioner_type(self) -> DataFrame:
        codes = taxonomy_codes(self.panel("ptaxcode"), self.entity(), 1, self.taxonomy)
        return practitioner_types(self.credentials(),
                                  categorized_codes(codes, self.taxonomy))

    def licenses(self) -> DataFrame:
        return licences(self.panel("PLICSTATE"), self.panel("PLICNUM"), self.removaldate())

    def gender(self) -> DataFrame:
        return gender(self.panel("pgender"), self.entity())

    def penumdate(self) -> DataFrame:
        return enumeration_dates(self.panel("penumdate"))

    def address(self, column: str) -> DataFrame:
        return address_part(self.panel(column), self.entity(), self.removaldate(), column,
                            self.entities)

    def name_part(self, part: str) -> DataFrame:
        build = other_name_part if part.endswith("oth") else legal_name_part
        return build(self.panel(part), self.entity(), part)

    def secondary_practice_locations(self) -> DataFrame:
        return secondary_locations([self.panel(v) for v in S.SECONDARY_HEADERS])

    def fullnames(self) -> DataFrame:
        from rosterlake.plans.names import clean_full_names, full_names
        legal = ["pfname", "pmname", "plname", "pnamesuffix"]
        return clean_full_names(full_names(
            {p: self.name_part(p) for p in legal},
            {p: self.name_part(p + "oth") for p in legal}))

    def expanded_fullnames(self) -> DataFrame:
        from rosterlake.plans.names import expand_names
        return expand_names(self.fullnames().drop("othflag"), "npi", "pfname", "pmname",
                            "plname", "pnamesuffix", suffix_in_last=True)

    @classmethod
    def attributes(cls) -> Mapping[str, str]:
        """What can be asked for, by name."""
        skip = {"panel", "attributes"}
        return {n: (getattr(cls, n).__doc__ or "").strip()
                for n in vars(cls) if not n.startswith("_") and n not in skip}

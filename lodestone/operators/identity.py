"""Identity resolution: a cascade of equal-key rules, without transitivity.

A record joins the first rule under which another record that no earlier rule took has its key: e-mail, phone, name with
location. Records that then share only a name are ambiguous and stay alone, as do all others.

Each rule is one count over a window by its key, on narrow rows (an id and four keys), so the cascade is four shuffles
and no join of its own; records without the key are dealt by their id, not all to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone import schema
from lodestone.errors import IdentityError

#: Rules in their order, and the fields that each matches.
RULES = {"email_match": ["contact.email"], "phone_match": ["contact.phone"], "name_location_match": ["full_name", "location.raw_location"], "ambiguous": ["full_name"], "no_match": []}
RULE_ORDER = list(RULES)
#: Where resolve keeps the keys of the rules.
KEYED = ["k0_", "k1_", "k2_", "k3_"]


def location_key() -> Column:
    """The raw location, else city, state and country."""
    parts = F.concat_ws("::", *(F.nullif(F.lower(f"location.{p}"), F.lit("")) for p in ("city", "state_or_region", "country")))
    return F.coalesce(F.nullif(F.lower("location.raw_location"), F.lit("")), F.nullif(parts, F.lit("")))


def keys() -> dict[str, Column]:
    name = F.lower("full_name")
    return {
        "email_match": F.lower("contact.email"),
        "phone_match": F.col("contact.phone"),
        "name_location_match": F.concat(F.lit("name_location::"), name, F.lit("::"), location_key()),
        "ambiguous": F.concat(F.lit("name::"), name),
    }


def group_id(rule: Column, key: Column) -> Column:
    safe = F.replace(F.replace(F.replace(key, F.lit(" "), F.lit("_")), F.lit("@"), F.lit("_at_")), F.lit("::"), F.lit("__"))
    return F.concat(F.lit("group::"), rule, F.lit("::"), safe)


def assign(normalized: DataFrame) -> DataFrame:
    """normalized_id, seq, rule, group_key and group_id of every record."""
    schema.require(normalized, ["normalized_id", "seq", "full_name", "contact", "location"], IdentityError)
    return _cascade(normalized, keys())


def _cascade(normalized: DataFrame, by: dict[str, Column]) -> DataFrame:
    out = normalized.select("normalized_id", "seq", *(k.alias(r) for r, k in by.items()), F.lit(None).cast("string").alias("rule"))
    for rule in by:
        key, free = F.col(rule), F.col("rule").isNull()
        same = Window.partitionBy(F.coalesce(key, F.concat(F.lit("\0"), "normalized_id")))
        out = out.withColumn("rule", F.when(free & key.isNotNull() & (F.count_if(free).over(same) >= 2), F.lit(rule)).otherwise(F.col("rule")))
    rule = F.coalesce("rule", F.lit("no_match"))
    shared = F.when(rule == "email_match", F.col("email_match")).when(rule == "phone_match", F.col("phone_match")).when(rule == "name_location_match", F.col("name_location_match"))
    key = F.coalesce(shared, F.col("normalized_id"))
    alone = F.when(rule == "ambiguous", F.concat(F.lit("ambiguous::"), F.col("ambiguous"))).otherwise(F.concat(F.lit("no_match::"), "normalized_id"))
    group_key = F.coalesce(shared, alone)
    return out.select("normalized_id", "seq", rule.alias("rule"), group_key.alias("group_key"), group_id(rule, key).alias("group_id"))


def status() -> Column:
    return F.when(F.col("rule").isin("ambiguous", "no_match"), F.col("rule")).otherwise("matched")


def evidence() -> Column:
    """What the group rests on."""
    fields = F.coalesce(*(F.when(F.col("rule") == r, F.array(*map(F.lit, f)).cast("array<string>")) for r, f in RULES.items()))
    # The notes' wording.
    note = (
        F.when(F.col("rule") == "ambiguous", F.lit("Same normalized name appears multiple times without an exact email, phone, or name+location match."))
        .when(F.col("rule") == "no_match", F.lit("No deterministic identity rule matched this record to any other record."))
        .otherwise(F.concat(F.lit("Exact deterministic match on "), F.array_join(fields, ", "), F.lit(".")))
    )
    return F.array(F.struct(F.col("rule").alias("rule_name"), fields.alias("matched_fields"), F.lit(1.0).alias("confidence"), note.alias("notes")))


def keyed(normalized: DataFrame, instead: dict[str, Column]) -> DataFrame:
    """The records with the values of instead for columns of its names; the keys they had before are in KEYED."""
    return normalized.select(*(instead[c].alias(c) if c in instead else c for c in normalized.columns), *(k.alias(n) for n, k in zip(KEYED, keys().values())))


def resolve(normalized: DataFrame, instead: dict[str, Column] | None = None) -> DataFrame:
    """The records with rule, group_key, group_id and resolution_status. The wide rows are joined once, by their id.

    The cascade and the join read the same shuffle of the records, so each record is made once. instead: values that
    columns take once the keys are made, for a result that doesn't need the columns.
    """
    dealt = keyed(normalized, instead or {}).repartition("normalized_id")
    # Always true, and the hash is never computed: it names all columns, or else each reader's shuffle would be cut to its own columns and made anew.
    dealt = dealt.filter((F.spark_partition_id() >= 0) | (F.hash(*dealt.columns) == 0))
    found = _cascade(dealt, dict(zip(keys(), map(F.col, KEYED)))).drop("seq")
    return dealt.drop(*KEYED).join(found, "normalized_id").withColumn("resolution_status", status())


def groups(normalized: DataFrame) -> DataFrame:
    """One row per group: rule, status, size and record ids in the order of ingest; groups in the order of the rules have rule_order."""
    found = assign(normalized)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("seq", "normalized_id"))), lambda x: x.normalized_id)
    made = found.groupBy("group_id", "group_key", "rule").agg(F.count("*").alias("group_size"), ids.alias("record_ids"))
    order = F.array_position(F.array(*map(F.lit, RULE_ORDER)), F.col("rule")).cast("int")
    return made.withColumn("resolution_status", status()).withColumn("rule_order", order).withColumn("match_evidence", evidence())

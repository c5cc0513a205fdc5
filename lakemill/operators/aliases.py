"""Match free-form names to groups of a dictionary, by tiers.

Tiers, best first: the name is a group's key; it is one of its variants; a variant is
inside the name or the name inside a variant; enough of a variant's words are in the
name. The lowest tier wins, then the dictionary's order.

No tier compares every name with every variant. A match must share tokens (n-grams or
words), and one of them is enough to find it: where the variant lies in the name, the
variant's rarest n-gram; where the name lies in the variant, the name's rarest; where words
are shared, the variant's rarest words. Rare means few variants hold it, so a popular beginning
or word finds no more than the rare ones do. The pairs found are then tested in full.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.canonical import compose
from lakemill.functions.scalar import let, words
from lakemill.operators.bounds import checked_broadcast
from lakemill.operators.joins import skew_lookup
from lakemill.session import cut


@dataclass(frozen=True)
class AliasRules:
    """Thresholds of the tiers.

    ``one_substring_tier``: both directions count alike and both need a variant of
    ``variant_in_name`` letters; otherwise the name-in-variant tier comes after and needs
    a name of ``name_in_variant`` letters.
    """

    min_name: int
    variant_in_name: int
    name_in_variant: int
    one_substring_tier: bool
    overlap: float


ORG_RULES = AliasRules(min_name=2, variant_in_name=4, name_in_variant=3, one_substring_tier=False, overlap=0.6)
MAJ_RULES = AliasRules(min_name=1, variant_in_name=3, name_in_variant=1, one_substring_tier=True, overlap=0.8)

# Keys that are public bodies, and the two label prefixes.
PUBLIC_BODIES = [
    "bộ giáo dục và đào tạo",
    "bộ quốc phòng",
    "bộ công an",
    "bộ y tế",
    "sở giáo dục và đào tạo",
    "bộ tài nguyên môi trường",
    "bộ khoa học công nghệ",
    "bộ nông nghiệp",
    "bộ công thương",
    "bộ thương mại",
    "chính phủ việt nam",
]
SCHOOL_PREFIX = "trường - "
BODY_PREFIX = "tổ chức - "

#: Letters of the n-grams by which a name is looked for inside variants; a shorter name is its own.
PART = 3


def org_label(key: Column) -> Column:
    """A key as stored: prefixed by kind unless it already names one."""
    return (
        F.when(key.contains(" - "), key)
        .when(key.isin(*PUBLIC_BODIES), F.concat(F.lit(BODY_PREFIX), key))
        .otherwise(F.concat(F.lit(SCHOOL_PREFIX), key))
    )


def _grams(text: Column, size: int) -> Column:
    last = F.length(text) - size + 1
    none = F.expr("cast(array() as array<string>)")
    return F.when(
        last >= 1,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: text.substr(i, F.lit(size)))),
    ).otherwise(none)


def _tagged(kind: str, tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))


def _rarest(alias: DataFrame, tokens: Column, how_many: Column) -> DataFrame:
    """Each variant under its ``how_many`` tokens that fewest variants share."""
    each = alias.select("*", F.explode(tokens).alias("token"))
    share = each.groupBy("token").agg(F.count(F.lit(1)).alias("share"))
    listed = each.join(share, "token").groupBy(*alias.columns).agg(
        F.array_sort(F.collect_list(F.struct("share", "token"))).alias("listed")
    )
    taken = F.slice(F.col("listed"), F.lit(1), how_many)
    return listed.select(*alias.columns, F.explode(F.transform(taken, lambda x: x["token"])).alias("token"))


def alias_index(aliases: DataFrame, rules: AliasRules) -> DataFrame:
    """Dictionary rows filed under the tokens a matching name must have.

    ``aliases``: (grp, key_ord, variant, var_ord), each group's variants in order.
    """
    base = aliases.select("grp", "key_ord", compose("variant").alias("variant"), "var_ord")
    keys = aliases.select("grp", "key_ord").distinct()
    text = F.col("variant")
    spread = F.array_distinct(words(text))
    needed = F.ceil(F.lit(rules.overlap) * F.size(spread) - 1e-9).cast("int")

    exact_key = keys.select(
        "grp", "key_ord", F.col("grp").alias("variant"), F.lit(0).alias("var_ord"),
        compose("grp").alias("token"), F.lit("whole").alias("kind"), F.lit(1).alias("tier"),
    )
    exact_variant = base.withColumns({"token": text, "kind": F.lit("whole"), "tier": F.lit(2)})
    long_enough = base.filter(F.length(text) >= rules.variant_in_name)
    inside = _rarest(long_enough, _grams(text, rules.variant_in_name), F.lit(1)).withColumns(
        {"kind": F.lit("gram"), "tier": F.lit(3)}
    )
    sizes = range(rules.name_in_variant, PART + 1)
    grams = F.concat(*[_grams(text, n) for n in sizes])
    around_from = long_enough if rules.one_substring_tier else base
    around = around_from.select("*", F.explode(F.array_distinct(grams)).alias("token")).withColumns(
        {"kind": F.lit("part"), "tier": F.lit(3 if rules.one_substring_tier else 4)}
    )
    shared = _rarest(base.filter(F.size(spread) > 0), spread, F.size(spread) - needed + 1).withColumns(
        {"kind": F.lit("word"), "tier": F.lit(5)}
    )
    columns = ["kind", "token", "tier", "grp", "key_ord", "variant", "var_ord"]
    parts = [exact_key, exact_variant, inside, around, shared]
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def _name_tokens(name: Column, rules: AliasRules) -> Column:
    return F.concat(
        _tagged("whole", F.array(name)),
        _tagged("gram", _grams(name, rules.variant_in_name)),
        _tagged("word", F.array_distinct(words(name))),
    )


def _rarest_parts(distinct: DataFrame, index: DataFrame, rules: AliasRules) -> DataFrame:
    """Each name under its n-gram that fewest variants hold. A name with one that none holds is in no variant."""
    name = F.col("__name")
    parts = F.when(F.length(name) >= PART, _grams(name, PART)).otherwise(F.array(name))
    each = distinct.filter(F.length(name) >= rules.name_in_variant).select("__raw", "__name", F.explode(parts).alias("token"))
    share = index.filter("kind = 'part'").groupBy("token").agg(F.count(F.lit(1)).alias("share"))
    met = each.join(checked_broadcast(share), "token", "left")
    rarest = met.groupBy("__raw", "__name").agg(F.min(F.struct(F.coalesce("share", F.lit(0)).alias("share"), "token")).alias("least"))
    return rarest.filter("least.share > 0").select("__raw", "__name", F.lit("part").alias("kind"), F.col("least.token").alias("token"))


def _passes(name: Column, rules: AliasRules) -> Column:
    kind, variant = F.col("kind"), F.col("variant")
    ratio = let(
        F.array_distinct(words(variant)),
        lambda v: F.size(F.array_intersect(v, F.array_distinct(words(name)))) / F.size(v),
    )
    return (
        F.when(kind == "whole", F.lit(True))
        .when(kind == "gram", name.contains(variant))
        .when(kind == "part", variant.contains(name))
        .otherwise(ratio >= rules.overlap)
    )


def candidate_pairs(names: DataFrame, column: str, aliases: DataFrame, rules: AliasRules) -> DataFrame:
    """(__raw, __name) of each distinct name beside the dictionary rows it must be tested against."""
    name = F.col("__name")
    distinct = (
        names.select(F.trim(F.lower(F.col(column))).alias("__name"), F.col(column).alias("__raw"))
        .filter(F.length("__name") >= rules.min_name)
        .distinct()
    )
    tokens = distinct.select("__raw", "__name", F.explode(let(name, lambda n: _name_tokens(n, rules))).alias("__t")).select(
        "__raw", "__name", F.col("__t.kind").alias("kind"), F.col("__t.token").alias("token")
    )
    # Measured and joined, so made once.
    index = cut(alias_index(aliases, rules))
    asked = tokens.unionByName(_rarest_parts(distinct, index, rules))
    return asked.join(checked_broadcast(index), ["kind", "token"], "inner")


def match_names(names: DataFrame, column: str, aliases: DataFrame, rules: AliasRules) -> DataFrame:
    """(column, grp) for each distinct name that matches some group."""
    pairs = candidate_pairs(names, column, aliases, rules)
    best = pairs.filter(_passes(F.col("__name"), rules)).groupBy("__raw").agg(
        F.min(F.struct("tier", "key_ord", "var_ord", "grp")).alias("__best")
    )
    return best.select(F.col("__raw").alias(column), F.col("__best.grp").alias("grp"))


def alias_match(df: DataFrame, column: str, aliases: DataFrame, rules: AliasRules, name: str) -> DataFrame:
    """Rows with the group their (already normalised) name belongs to, NULL if none.

    Distinct names are matched once. The way back is safe for a name that very many
    rows share.
    """
    found = match_names(df, column, aliases, rules).withColumnRenamed("grp", name)
    return skew_lookup(df, found, column, [name])

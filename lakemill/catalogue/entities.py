"""Posts, entities, topics and names, on documents tagged by the shape of their words."""

from pyspark.sql import functions as F

from lakemill.catalogue.registry import query, table, wide_table
from lakemill.functions import names, spans
from lakemill.functions.minitext import split_labels
from lakemill.functions.scalar import words
from lakemill.operators import aliases, keys, quality, social


def rule_tags(text, step=5):
    """A tag per word from its length and first letter, with stray and clashing ``I-`` tags."""

    def tag(w):
        left = F.pmod(F.length(w), F.lit(step))
        return (
            F.when(left == 0, "B-MAJ")
            .when(left == 1, "I-MAJ")
            .when(w.rlike("^[A-Z]"), "B-ORG")
            .when(left == 2, "I-ORG")
            .otherwise("O")
        )

    return F.array_join(F.transform(words(text), tag), " ")


def rule_topics():
    return F.concat_ws("|", "lang", F.when(F.col("n_chars") > 1000, "CAREER").otherwise("None"), "source", F.lit(" "))


def tagged(spark, sf):
    return wide_table(spark, sf, "documents").select(
        "doc_id", "text", "lang", "source", "n_chars", rule_tags("text").alias("tags"), rule_topics().alias("topics")
    )


def tag_sql(step=5):
    return f"""CASE WHEN length(w) % {step} = 0 THEN 'B-MAJ' WHEN length(w) % {step} = 1 THEN 'I-MAJ'
        WHEN regexp_matches(w, '^[A-Z]') THEN 'B-ORG' WHEN length(w) % {step} = 2 THEN 'I-ORG' ELSE 'O' END"""


TOKENS = """w0 AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS ws FROM documents),
  w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w0)"""


def span_sql(tags, out, stray):
    """Islands: a run breaks where a tag does not go on from the one before."""
    keep = "tag <> 'O'" if stray else "tag LIKE 'B-%'"
    return f"""{out}a AS (SELECT *, lag(tag) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM {tags}),
  {out}b AS (SELECT *, CASE WHEN tag LIKE 'I-%' AND p <> 'O' AND substr(tag, 3) = substr(p, 3) THEN 0 ELSE 1 END AS brk FROM {out}a),
  {out}c AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM {out}b),
  {out} AS (SELECT doc_id, run, arg_min(tag, i) AS tag, min(i) AS first, max(i) AS last, string_agg(w, ' ' ORDER BY i) AS name
            FROM {out}c GROUP BY doc_id, run HAVING arg_min({keep}, i))"""


ENTITIES = f"""{TOKENS}, g AS (SELECT *, {tag_sql()} AS tag FROM w), {span_sql("g", "sp", False)},
  ent AS (SELECT doc_id, substr(tag, 3) AS type, trim(regexp_replace(replace(name, '_', ' '), '^\\.+|\\.+$', '', 'g')) AS name
          FROM sp), e AS (SELECT * FROM ent WHERE name <> '')"""


@query("tag_types", f"""WITH {TOKENS} SELECT DISTINCT doc_id, substr({tag_sql()}, 3) AS type FROM w WHERE {tag_sql()} <> 'O'""")
def tag_types(spark, sf):
    return tagged(spark, sf).select("doc_id", F.explode(spans.tag_types("tags")).alias("type"))


@query("bio_entities", f"WITH {ENTITIES} SELECT doc_id, type AS \"entityType\", name AS \"entityName\" FROM e")
def bio_entities(spark, sf):
    return tagged(spark, sf).select("doc_id", F.explode(spans.clean_entities("tags", "text")).alias("e")).select("doc_id", "e.*")


@query(
    "aligned_only",
    f"WITH {TOKENS} SELECT doc_id, count(*) AS n_words FROM w JOIN documents USING (doc_id) WHERE source <> 'src1' GROUP BY doc_id",
)
def aligned_only(spark, sf):
    broken = tagged(spark, sf).withColumn("tags", F.when(F.col("source") == "src1", F.concat("tags", F.lit(" O"))).otherwise(F.col("tags")))
    kept = broken.filter(spans.aligned("tags", "text"))
    return kept.select("doc_id", F.size(words("text")).cast("bigint").alias("n_words"))


def entity_table(spark, sf):
    members = social.describe_entities(social.entity_members(tagged(spark, sf), "tags"))
    return keys.surrogate_key(members, "entityID", ["entityType"])


def topic_table(spark, sf):
    members = social.describe_topics(social.topic_members(tagged(spark, sf), "topics"))
    return keys.surrogate_key(members, "topicID", ["topicName"])


@query(
    "bridge_entity",
    f"""WITH {ENTITIES} SELECT doc_id, CASE type WHEN 'MAJ' THEN 1 ELSE 2 END AS "entityID",
            CAST(row_number() OVER (PARTITION BY doc_id ORDER BY type, name) AS INTEGER) AS "entityOrder", name AS "entityName" FROM e""",
)
def bridge_entity(spark, sf):
    return social.bridge_entity(tagged(spark, sf), entity_table(spark, sf), "doc_id", "tags", "text").drop("entityNameNormalized")


LABELS = """tl AS (SELECT DISTINCT doc_id, unnest([lang, source, CASE WHEN n_chars > 1000 THEN 'CAREER' END]) AS label FROM documents),
  l AS (SELECT * FROM tl WHERE label IS NOT NULL),
  d AS (SELECT label, row_number() OVER (ORDER BY label) AS id FROM (SELECT DISTINCT label FROM l))"""


@query("bridge_topic", f"""WITH {LABELS} SELECT doc_id, id AS "topicID" FROM l JOIN d USING (label)""")
def bridge_topic(spark, sf):
    return social.bridge_topic(tagged(spark, sf), topic_table(spark, sf), "doc_id", "topics")


@query(
    "dict_describe",
    """SELECT label AS "topicName", CASE label WHEN 'CAREER' THEN 'Nghề nghiệp, lương' ELSE 'Chủ đề khác' END AS "topicDetail"
       FROM (SELECT unnest([lang, source, 'CAREER']) AS label FROM documents) GROUP BY label""",
)
def dict_describe(spark, sf):
    labels = table(spark, sf, "documents").select(F.explode(split_labels(F.concat_ws("|", "lang", "source", F.lit("CAREER")))).alias("topicName"))
    return social.describe_topics(labels.distinct())


@query(
    "grow_dict",
    """WITH k AS (SELECT p_type AS name, row_number() OVER (ORDER BY p_type) AS id FROM (SELECT DISTINCT p_type FROM part)),
         m AS (SELECT DISTINCT unnest([c_mktsegment, 'LARGE']) AS name FROM customer)
       SELECT name, id FROM k UNION ALL
       SELECT name, (SELECT max(id) FROM k) + row_number() OVER (ORDER BY name) FROM m WHERE name NOT IN (SELECT name FROM k)""",
)
def grow_dict(spark, sf):
    known = keys.surrogate_key(table(spark, sf, "part").select(F.col("p_type").alias("name")).distinct(), "id", ["name"])
    met = table(spark, sf, "customer").select(F.explode(F.array(F.col("c_mktsegment"), F.lit("LARGE"))).alias("name"))
    return known.select("name", "id").unionByName(keys.grow_dictionary(known, met, "name", "id").select("name", "id"))


@query(
    "mention_distribution",
    f"""WITH {ENTITIES} SELECT type AS "entityType", count(*) AS mention_count FROM e GROUP BY type""",
)
def mention_distribution(spark, sf):
    types = entity_table(spark, sf)
    bridge = social.bridge_entity(tagged(spark, sf), types, "doc_id", "tags", "text")
    return quality.mention_distribution(types, bridge).drop("entityDetail")


@query(
    "most_mentioned",
    f"""WITH {ENTITIES} SELECT type AS "entityType", name AS "entityName", count(DISTINCT doc_id) AS mention_count FROM e
        GROUP BY type, name ORDER BY mention_count DESC, type, name LIMIT 20""",
)
def most_mentioned(spark, sf):
    types = entity_table(spark, sf)
    bridge = social.bridge_entity(tagged(spark, sf), types, "doc_id", "tags", "text").withColumnRenamed("doc_id", "postID")
    return quality.most_mentioned(types, bridge)


@query(
    "samples_per_type",
    f"""WITH {ENTITIES}, r AS (SELECT type AS "entityType", name AS sample_value,
            CAST(row_number() OVER (PARTITION BY type ORDER BY name) AS INTEGER) AS rn FROM e) SELECT * FROM r WHERE rn <= 5""",
)
def samples_per_type(spark, sf):
    types = entity_table(spark, sf)
    bridge = social.bridge_entity(tagged(spark, sf), types, "doc_id", "tags", "text")
    return quality.samples_per_type(types, bridge).drop("entityDetail")


@query(
    "topic_distribution",
    f"""WITH {LABELS} SELECT label AS "topicName", CASE label WHEN 'CAREER' THEN 'Nghề nghiệp, lương' ELSE 'Chủ đề khác' END AS "topicDetail",
            count(*) AS post_count FROM l GROUP BY label""",
)
def topic_distribution(spark, sf):
    topics = topic_table(spark, sf)
    return quality.topic_distribution(topics, social.bridge_topic(tagged(spark, sf), topics, "doc_id", "topics"))


@query(
    "intent_distribution",
    """SELECT CASE WHEN contains(text, ',') THEN 'list' ELSE 'plain' END AS intent, count(*) AS count FROM documents GROUP BY 1""",
)
def intent_distribution(spark, sf):
    intent = F.when(F.col("text").contains(","), "list").otherwise("plain")
    return quality.intent_distribution(table(spark, sf, "documents").select(intent.alias("intent")))


@query(
    "normalised_groups",
    """SELECT CASE WHEN p_size > 10 THEN p_brand END AS "entityNameNormalized", count(*) AS total_records,
              count(DISTINCT p_name) AS distinct_original_names FROM part WHERE p_type = 'SMALL' GROUP BY 1""",
)
def normalised_groups(spark, sf):
    part = table(spark, sf, "part")
    types = keys.surrogate_key(part.select(F.col("p_type").alias("entityType")).distinct(), "entityID", ["entityType"])
    named = part.select(
        F.col("p_type").alias("entityType"), F.col("p_name").alias("entityName"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("entityNameNormalized"),
    )
    bridge = named.join(types, "entityType").drop("entityType")
    return quality.normalised_groups(bridge, types, "SMALL")


def messy_name():
    kind, name = F.col("p_type"), F.col("p_name")
    return (
        F.when(kind == "SMALL", F.concat(F.lit("  Đại học "), name, F.lit(" (Cơ sở 2), ")))
        .when(kind == "LARGE", F.concat(F.lit("TRƯỜNG & "), name, F.lit(" (cũ) - Địa chất!?")))
        .when(kind == "PROMO", F.concat(F.lit("Ngành nghề học  "), name))
        .when(kind == "MEDIUM", F.concat(F.lit('"Chuyên ngành" '), name))
        .otherwise(name)
    )


@query(
    "normalize_org",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'đại học ' || p_name || ' cơ sở 2' WHEN 'LARGE' THEN 'trường ' || p_name || ' - địa chất'
              WHEN 'PROMO' THEN 'ngành nghề học ' || p_name WHEN 'MEDIUM' THEN 'chuyên ngành ' || p_name ELSE p_name END AS name FROM part""",
)
def normalize_org(spark, sf):
    return table(spark, sf, "part").select("p_partkey", names.normalize_org(messy_name()).alias("name"))


@query(
    "normalize_maj",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'đại học ' || p_name || ' (cơ sở 2),'
              WHEN 'LARGE' THEN 'trường & ' || p_name || ' (cũ) - địa chất!?'
              ELSE p_name END AS name FROM part""",
)
def normalize_maj(spark, sf):
    return table(spark, sf, "part").select("p_partkey", names.normalize_maj(messy_name()).alias("name"))


# A small dictionary written for the test tables; real ones are passed in as a table.
SAMPLE_ALIASES = [
    ("bolt", 1, "bolt", 1), ("bolt", 1, "red bolt", 2), ("bolt", 1, "iron", 3),
    ("bộ y tế", 2, "hot gear", 1), ("bộ y tế", 2, "gears of any kind", 2),
    ("ring - maker", 3, "ring", 1), ("ring - maker", 3, "old ring maker", 2),
    ("widgets", 4, "widget", 1), ("widgets", 4, "blue widget number", 2), ("widgets", 4, "gizmo brand 7", 3),
    ("small anvil", 5, "an", 1), ("small anvil", 5, "large plate of brand 2", 2), ("plates", 6, "new old plate", 1),
]
ALIAS_ROWS = ", ".join(str(a) for a in SAMPLE_ALIASES)
ALIAS_NAME = {
    "org": "CASE WHEN p_type = 'SMALL' THEN p_name WHEN p_type = 'LARGE' THEN substr(p_name, 1, 3) ELSE p_name || ' ' || lower(replace(p_brand, '#', ' ')) END",
    "maj": "CASE WHEN p_type = 'SMALL' THEN p_name WHEN p_type = 'LARGE' THEN substr(p_name, 1, 2) ELSE p_name || ' ' || lower(replace(p_brand, '#', ' ')) END",
}


def alias_frame(spark):
    return spark.createDataFrame(SAMPLE_ALIASES, "grp string, key_ord int, variant string, var_ord int")


def alias_sql(kind, tiers, least):
    """Every name against every variant: the plain reading of the tiers."""
    return f"""WITH a(grp, ko, v, vo) AS (VALUES {ALIAS_ROWS}), n AS (SELECT DISTINCT {ALIAS_NAME[kind]} AS name FROM part),
      x AS (SELECT *, len(list_intersect(list_distinct(string_split(v, ' ')), list_distinct(string_split(name, ' '))))
                      / len(list_distinct(string_split(v, ' '))) AS share FROM n, a WHERE length(name) >= {least}),
      y AS (SELECT *, {tiers} AS tier FROM x),
      z AS (SELECT name, arg_min(grp, tier * 1000000 + ko * 1000 + vo) AS grp FROM y WHERE tier IS NOT NULL GROUP BY name)
      SELECT p_partkey, grp FROM (SELECT p_partkey, {ALIAS_NAME[kind]} AS name FROM part) LEFT JOIN z USING (name)"""


ORG_TIERS = """CASE WHEN name = grp THEN 1 WHEN name = v THEN 2 WHEN length(v) >= 4 AND contains(name, v) THEN 3
    WHEN length(name) >= 3 AND contains(v, name) THEN 4 WHEN share >= 0.6 THEN 5 END"""
MAJ_TIERS = """CASE WHEN name = grp THEN 1 WHEN name = v THEN 2
    WHEN length(v) >= 3 AND (contains(name, v) OR contains(v, name)) THEN 3 WHEN share >= 0.8 THEN 5 END"""


@query(
    "alias_org",
    alias_sql("org", ORG_TIERS, 2).replace(
        "SELECT p_partkey, grp FROM",
        """SELECT p_partkey, CASE WHEN contains(grp, ' - ') THEN grp WHEN grp = 'bộ y tế' THEN 'tổ chức - ' || grp
           ELSE 'trường - ' || grp END AS grp FROM""",
    ),
)
def alias_org(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.expr(ALIAS_NAME["org"]).alias("name"))
    matched = aliases.alias_match(part, "name", alias_frame(spark), aliases.ORG_RULES, "grp")
    return matched.select("p_partkey", aliases.org_label(F.col("grp")).alias("grp"))


@query("alias_maj", alias_sql("maj", MAJ_TIERS, 1))
def alias_maj(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.expr(ALIAS_NAME["maj"]).alias("name"))
    return aliases.alias_match(part, "name", alias_frame(spark), aliases.MAJ_RULES, "grp").select("p_partkey", "grp")

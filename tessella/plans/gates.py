"""Quality gates and rejection cascades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.gates import falsy, first_reason, reasons
from tessella.plans.registry import query, table

#: name, condition (valid in both SQL dialects); strict comparisons reject, equality passes
LINE_RULES = (
    ("too_cheap", "l_extendedprice < 2000"),
    ("too_dear", "l_extendedprice > 90000"),
    ("few", "l_quantity < 3"),
    ("many", "l_quantity > 48"),
    ("discount_high", "l_discount > 0.09"),
    ("tax_high", "l_tax > 0.07"),
    ("returned", "l_returnflag = 'R'"),
    ("open_line", "l_linestatus = 'O' and l_quantity < 10"),
    ("unit_price_mismatch", "abs(l_extendedprice / l_quantity - 1500) > 900"),
    ("late_slot", "l_linenumber > 6"),
)


def _line_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("reasons", reasons(*((n, F.expr(c)) for n, c in LINE_RULES)))


_REASONS_SQL = "list_filter([" + ", ".join(f"case when {c} then '{n}' end" for n, c in LINE_RULES) + "], lambda x: x is not null)"


@query(f"select array_to_string({_REASONS_SQL}, '+') as reasons, count(*) as rows from lineitem group by 1")
def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rules, all failing ones in fixed order; the empty string is a pass."""
    return _line_reasons(spark, sf_dir).groupBy(F.array_join("reasons", "+").alias("reasons")).agg(F.count("*").alias("rows"))


@query(f"select coalesce(({_REASONS_SQL})[1], 'passed') as reason, count(*) as rows from lineitem group by 1")
def gate_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_reasons(spark, sf_dir).groupBy(F.coalesce(F.get("reasons", F.lit(0)), F.lit("passed")).alias("reason")).agg(F.count("*").alias("rows"))


@query(f"select reason, count(*) as rows from (select unnest({_REASONS_SQL}) as reason from lineitem) group by reason")
def gate_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_reasons(spark, sf_dir).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


@query(f"""
select p_type as class_name, count(*) as rows, count(*) filter (len({_REASONS_SQL}) = 0) as accepted,
       round_even(count(*) filter (len({_REASONS_SQL}) = 0) / count(*), 4)::double as accepted_share
from lineitem join part on l_partkey = p_partkey group by p_type
""")
def gate_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's decision kept on every row, accepted or not, and summed per class."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("class_name"))
    gated = _line_reasons(spark, sf_dir).select("l_partkey", F.struct((F.size("reasons") == 0).alias("accepted"), "reasons").alias("quality_gate"))
    ok = F.count_if(F.coalesce("quality_gate.accepted", F.lit(False)))
    return gated.join(part, "l_partkey").groupBy("class_name").agg(F.count("*").alias("rows"), ok.alias("accepted"), F.bround(ok / F.count("*"), 4).alias("accepted_share"))


@query("""
with m as (select doc_id, (len(text) - len(replace(text, ' ', '')))::double / nullif(n_chars, 0) as blanks, quality from documents left join labels using (doc_id))
select case when blanks is null then 'no_metrics' when blanks > 0.25 then 'blanks>0.25' when quality is null then 'no_second_metric' when quality < 1 then 'quality<1' else 'passed' end as reason,
       count(*) as rows from m group by 1
""")
def source_precheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thresholds; a missing metric is a reason of its own."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.try_divide(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))), F.col("n_chars")).alias("blanks")
    )
    m = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    rule = first_reason(("no_metrics", F.col("blanks").isNull()), ("blanks>0.25", F.col("blanks") > 0.25), ("no_second_metric", F.col("quality").isNull()), ("quality<1", F.col("quality") < 1))
    return m.groupBy(F.coalesce(rule, F.lit("passed")).alias("reason")).agg(F.count("*").alias("rows"))


@query("""
select case when n_chars < 200 then 'too_short' when n_chars > 8000 then 'too_long' when lang not in ('en', 'fr', 'de') then 'language'
            when source in ('src1', 'src2') then 'held_out_source' when doc_id in (select doc_id from labels where quality = 0) then 'held_out_id' end as reason, count(*) as rows
from documents group by 1
""")
def reject_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rules, one reason a row; null is a pass. Two-key exclusion stays two joins."""
    bad = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct().withColumn("held", F.lit(True))
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source").join(bad, "doc_id", "left")
    rule = first_reason(
        ("too_short", F.col("n_chars") < 200), ("too_long", F.col("n_chars") > 8000), ("language", ~F.col("lang").isin("en", "fr", "de")),
        ("held_out_source", F.col("source").isin("src1", "src2")), ("held_out_id", F.col("held")),
    )
    return docs.groupBy(rule.alias("reason")).agg(F.count("*").alias("rows"))


@query("""
select p_brand, count(*) as rows, count(*) filter (case p_type when 'PROMO' then 'promo' when 'STANDARD' then 'std' when 'ECONOMY' then 'eco' end is null) as unmapped,
       count(*) filter (least(p_size, 50 - p_size) >= 5) as inside, count(*) filter (p_size >= 18 and p_retailprice <= 1500) as in_window
from part group by p_brand
""")
def mapped_and_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class mapping in which the unmapped is rejected, an edge predicate, a size window."""
    mapping = F.create_map(*map(F.lit, ("PROMO", "promo", "STANDARD", "std", "ECONOMY", "eco")))
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count("*").alias("rows"), F.count_if(F.try_element_at(mapping, F.col("p_type")).isNull()).alias("unmapped"),
        F.count_if(F.least(F.col("p_size"), 50 - F.col("p_size")) >= 5).alias("inside"), F.count_if(F.expr("p_size >= 18 and p_retailprice <= 1500")).alias("in_window"),
    )


@query("""
with s as (select page_id, regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^www\\.', '') as host, nullif(regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1), '') as scene from pages),
bg as (select scene from s where page_id = (select min(page_id) from s where scene is not null))
select host, count(*) as pages, count(*) filter (scene is distinct from (select scene from bg)) as other_scene, count(*) filter (scene is null) as no_scene from s group by host
""")
def null_safe_scene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of another scene than the background's; a page without scene stays."""
    s = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_replace(F.regexp_extract("url", "^https?://([^/]+)", 1), "^www\\.", "").alias("host"),
        F.nullif(F.regexp_extract("url", "^https?://[^/]+/([^/?#]+)", 1), F.lit("")).alias("scene"),
    )
    background = s.where("scene is not null").agg(F.min_by("scene", "page_id").alias("background"))  # one row
    both = s.crossJoin(F.broadcast(background))
    return both.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(~F.col("scene").eqNullSafe(F.col("background"))).alias("other_scene"), F.count_if(F.col("scene").isNull()).alias("no_scene")
    )


@query("""
select coalesce(nullif(nullif(p_type, 'PROMO'), ''), p_brand) as label, count(*) as rows,
       count(*) filter (p_retailprice between 0 and 2000 and not isnan(p_retailprice)) as valid from part group by 1
""")
def falsy_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("given", F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type")))
    valid = ~F.isnan("p_retailprice") & F.col("p_retailprice").between(0, 2000)
    return part.groupBy(falsy(F.col("given"), F.col("p_brand")).alias("label")).agg(F.count("*").alias("rows"), F.count_if(valid).alias("valid"))

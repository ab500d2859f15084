"""One query per corpus operator, applied with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.bpe import token_counts
from starmart.llm.common import crc_of_id, staged, table
from starmart.llm.damage import damaged_turns, with_periodic_tails
from starmart.llm.decontaminate import find_leaks
from starmart.llm.jaccard import gram_links
from starmart.llm.langid import language_of
from starmart.llm.licenses import scan_licenses
from starmart.llm.mixing import pareto_mix
from starmart.llm.quality import document_statistics, score, train
from starmart.llm.repair import conversation_key, repair, transcript_digests
from starmart.llm.runs import collapse_runs
from starmart.llm.substrings import digest, remove_repeats
from starmart.llm.templates import drop_template_lines
from starmart.llm.tokens import read_index, token_digest, write_tokens
from starmart.llm.vectors import near_vectors


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("row")


def op2_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = pareto_mix(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_simple8b_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = write_tokens(table(spark, folder, "documents"), word_tokenizer())
    return token_digest(read_index(spark, path))


def op4_centroid_language(spark: SparkSession, folder: str) -> DataFrame:
    return language_of(table(spark, folder, "documents"))


def op5_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op6_rare_word_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op7_bucket_pointer_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return digest(remove_repeats(table(spark, folder, "documents")))


def op8_prefix_tree_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return gram_links(table(spark, folder, "documents"))


def op9_quadratic_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    stats = staged(document_statistics(table(spark, folder, "documents")), "quality-stats")
    scored = score(stats, train(stats, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(crc_of_id("doc_id") % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_log_templates(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_template_lines(table(spark, folder, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.length(text).cast("long").alias("kept_chars"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


def op11_square_catching_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = collapse_runs(with_periodic_tails(table(spark, folder, "documents")))
    # Greater length / period first, compared without division; then the smaller start and period.
    greater = "(l, r) -> case {} else 0 end".format(
        " ".join(
            f"when {a} < {b} then -1 when {a} > {b} then 1"
            for a, b in (("r.length * l.period", "l.length * r.period"), ("l.start", "r.start"), ("l.period", "r.period"))
        )
    )
    best = found.withColumn("best", F.expr(f"get(array_sort(runs, {greater}), 0)"))
    listed = F.transform("runs", lambda run: F.concat_ws(",", *[run[x].cast("string") for x in ("start", "length", "period")]))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{x}").alias(x) for x in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_heap_merge_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), byte_vocabulary())


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    made = repair(damaged_turns(given))
    whole = given.select("conv_id").distinct().withColumn("of_key", conversation_key("conv_id"))
    digests = transcript_digests(made.turns).withColumnRenamed("key", "hash_key")
    met = whole.join(made.audits, F.col("of_key") == F.col("key"), "left").join(digests, F.col("of_key") == F.col("hash_key"), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return met.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_pareto_mix": op2_pareto_mix,
    "op3_simple8b_tokens": op3_simple8b_tokens,
    "op4_centroid_language": op4_centroid_language,
    "op5_inverted_multi_index": op5_inverted_multi_index,
    "op6_rare_word_licenses": op6_rare_word_licenses,
    "op7_bucket_pointer_repeats": op7_bucket_pointer_repeats,
    "op8_prefix_tree_jaccard": op8_prefix_tree_jaccard,
    "op9_quadratic_discriminant": op9_quadratic_discriminant,
    "op10_log_templates": op10_log_templates,
    "op11_square_catching_runs": op11_square_catching_runs,
    "op12_heap_merge_counts": op12_heap_merge_counts,
    "op13_turn_repair": op13_turn_repair,
}


def _mix_sql() -> str:
    """The mix by whole windows, one step after the other, in the same arithmetic."""
    return rf"""
    with sized as (
        select doc_id, source,
            coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
        from documents
    ),
    weighed as (
        select source, sum(size)::bigint as source_size,
            (((row_number() over (order by source nulls last)) - 1) % 3 + 1)::double as weight
        from sized group by source
    ),
    levels as (
        select *, source_size / weight as reach,
            (sum(source_size) over ()::double - 3::double * coalesce(sum(source_size) over w, 0)::double)
                / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as level
        from weighed
        window w as (order by source_size / weight, weight, source nulls last rows between unbounded preceding and 1 preceding)
    ),
    judged as (select *, source_size * 3::double <= weight * level as capped from levels),
    plan as (
        select source, source_size, case when capped then source_size * 3::double
            else weight * (select level from judged where not capped order by reach, weight, source nulls last limit 1) end as target
        from judged
    ),
    rated as (
        select *, least(floor(case when source_size > 0 then target / source_size else 0::double end), 3)::bigint as sure
        from plan
    ),
    wanted as (select *, greatest(target - sure * source_size, 0::double) as need from rated),
    classes as (
        select source, floor(sqrt(size::double))::bigint as measure, sum(size)::bigint as words from sized group by all
    ),
    judged_classes as (
        select c.source, measure, words, need, source_size, target, sure,
            measure > 0 and measure::double * (need - coalesce(sum(words) over (w rows between unbounded preceding and 1 preceding), 0)::double)
                >= (sum(words * measure) over (w rows between current row and unbounded following))::double as certain
        from classes c join wanted p on c.source is not distinct from p.source
        window w as (partition by c.source order by measure desc)
    ),
    chances as (
        select *, case when measure = 0 then 0::double when certain then 1::double else least(1::double, measure::double * (
            (need - (sum(case when certain then words else 0 end) over (partition by source))::double)
            / (sum(case when certain then 0 else words * measure end) over (partition by source))::double)) end as p
        from judged_classes
    ),
    drawn as (
        select s.doc_id, s.source, s.size, source_size, target, sure, need, p,
            (('0x' || md5('17:' || s.doc_id)[1:12])::bigint::double + 0.5::double) / 281474976710656::double as u
        from sized s join chances c on s.source is not distinct from c.source and floor(sqrt(s.size::double))::bigint = c.measure
    ),
    ranked as (
        select *, case when p > 0 then row((u / (1 - u)) * ((1 - p) / p), size, doc_id::varchar) end as k from drawn
    ),
    walk1 as (select *, sum(size) over (partition by source order by k) as upto from ranked where p > 0),
    edge1 as (
        select source, min(case when upto > need then k end) as edge1,
            any_value(need) - coalesce(sum(case when upto <= need then size end), 0)::double as open
        from walk1 group by source
    ),
    first as (
        select r.*, edge1, open, p > 0 and (edge1 is null or k < edge1) as taken1,
            coalesce(p > 0 and k > edge1 and r.size <= open, false) as later
        from ranked r left join edge1 e on r.source is not distinct from e.source
    ),
    walk2 as (select *, sum(size) over (partition by source order by k) as upto from first where later),
    edge2 as (
        select source, min(case when upto > open then k end) as edge2, coalesce(sum(case when upto <= open then size end), 0) as got2
        from walk2 group by source
    ),
    both_walks as (
        select f.*, coalesce(got2, 0)::double as got2, taken1 or (later and (edge2 is null or k < edge2)) as kept
        from first f left join edge2 e on f.source is not distinct from e.source
    ),
    units as (
        select source, kept, k, any_value(size) as size, open, open - got2 as goal, sum(size)::bigint as words
        from both_walks where p > 0 and (not kept or p < 1) group by source, kept, k, open, got2
    ),
    near as (
        select * from (
            select *, row_number() over (partition by source, kept order by case when not kept then size > open end,
                case when kept then -k[1] else k[1] end, case when kept then -size else size end, k[3]) as nth
            from units
        ) where nth <= case when kept then 4 else 8 end
    ),
    pool as (
        select *, row_number() over (partition by source order by k) - 1 as i, count(*) over (partition by source) as n,
            goal + (sum(case when kept then words else 0 end) over (partition by source))::double as aim
        from near
    ),
    masks as (
        select source, aim, mask, sum(case when (mask >> i) & 1 = 1 then words else 0 end)::double as total,
            sum(case when ((mask >> i) & 1 = 1) <> kept then 1 else 0 end) as changed
        from pool join range(0, 4096) t(mask) on mask < (1 << n::int) group by source, aim, mask
    ),
    best as (select source, min(row(abs(aim - total), changed, mask))[3] as mask from masks group by source),
    flips as (
        select p.source, k from pool p join best b on p.source is not distinct from b.source where ((mask >> i) & 1 = 1) <> kept
    ),
    done as (
        select d.*, sure + (kept <> (f.k is not null))::bigint as copies
        from both_walks d left join flips f on d.source is not distinct from f.source and d.k = f.k
    )
    select doc_id, size, source_size, target, (copies * size)::bigint as taken, copies::bigint as copies from done"""


ORACLE: dict[str, str] = {"op2_pareto_mix": _mix_sql()}

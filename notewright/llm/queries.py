"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm import (
    context_tree, embedding_dedup, exact_dedup, filter_audit, hard_negatives, license_scan, line_dedup, mixing, quality,
    sentencepiece, simhash, toxicity, url_rules,
)
from notewright.llm.common import fold, table

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"

MIXTURE = {"refined": 0.95, "rough": 0.03, "harsh": 0.02}


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels outside fold 0 of 5."""
    scored = toxicity.toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for a mixture of mostly refined text; domains and their labels come from labels."""
    labels = table(spark, sf_dir, "labels")
    fitted = mixing.rates(table(spark, sf_dir, "documents"), mixing.quality_domains(labels), MIXTURE)
    return fitted.select(
        "doc_id", "tokens", *(F.round(F.col("p")[i], 6).alias(f"p_{d}") for i, d in enumerate(sorted(MIXTURE))),
        F.round("rate", 6).alias("rate"), "copies")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels outside fold 1 of 3."""
    scored = quality.quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a digest of what is left of every document."""
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "words_removed", F.sha2("text", 256).alias("text_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str = MODEL_FILE) -> DataFrame:
    """Piece counts, digests of the ids of the n best paths, their scores, and a digest of the decoded text."""
    others = [sentencepiece.nth_best(rank) for rank in range(2, sentencepiece.N_BEST + 1)]
    encoded = sentencepiece.encode_n_best(table(spark, sf_dir, "documents"), model_file).select(
        "doc_id", "ids", "n_best_scores", F.array(*map(F.xxhash64, others)).alias("others_xxhash64"))
    return sentencepiece.decode(encoded, model_file).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_xxhash64"),
        "others_xxhash64", "n_best_scores", F.sha2("text", 256).alias("decoded_sha256"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th vector is an anchor; every 7th has a label moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents outside fold 2 of 7."""
    learn = fold("doc_id", 7) != 2
    scored = context_tree.lm_scores(table(spark, sf_dir, "documents"), learn)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "bits_per_byte")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_license_scan": op6_license_scan,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_lm_scoring": op13_lm_scoring,
}


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _licence_sql() -> str:
    words = "regexp_extract_all({}, '" + license_scan.WORD + "')"
    quoted = lambda s: "'" + s + "'"
    places = " union all ".join(
        f"select doc_id, i, {quoted(label)} as label from w, unnest(range(len(ws))) as r(i) where "
        + " and ".join(f"ws[i + {k + 1}] = {quoted(word)}" for k, word in enumerate(phrase.split()))
        for phrase, label in license_scan.PHRASES.items())
    templates = ", ".join(
        f"({quoted(label)}, list_distinct({words.format('lower(' + quoted(text) + ')')}), "
        f"{license_scan.BLOCK} * len({words.format('lower(' + quoted(text) + ')')}))"
        for label, text in license_scan.TEMPLATES.items())
    return rf"""
        with d as (select doc_id, {_LOW} as low from documents),
        w as (select doc_id, low, {words.format('low')} as ws from d),
        places as ({places}),
        base as (select doc_id, count(*) as n, min(i) as first_word, max(i) as last_word,
                        string_agg(distinct label, ',' order by label) as base_labels from places group by 1),
        templates(label, tw, span) as (values {templates}),
        blocks as (select doc_id, label, tw, len(list_intersect(tw, ws[i + 1:i + span])) as n
                   from w, templates, unnest(range(len(ws))) as r(i) where list_contains(tw, ws[i + 1])),
        own as (select doc_id, label, max(n / len(tw)) as share
                from blocks where n >= {license_scan.THRESHOLD} * len(tw) - 1e-9 group by 1, 2),
        best as (select doc_id, max(share) as share from own group by 1),
        every as (select doc_id, string_agg(distinct label, ',' order by label) as labels
                  from (select doc_id, label from own union all select doc_id, label from places) group by 1)
        select doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_base, first_word::bigint as first_word,
               last_word::bigint as last_word, coalesce(base_labels, '') as base_labels,
               coalesce(labels, '') as labels,
               case when n > 0 then 1.0::double else coalesce(share, 0)::double end as score
        from w left join base using (doc_id) left join every using (doc_id) left join best using (doc_id)"""


ORACLES = {
    "op4_line_dedup": rf"""
        with l as (
          select doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws
          from (select doc_id, unnest(string_split(text, chr(10))) as line,
                       generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)),
        s as (
          select doc_id, pos, len(ws) as n, array_to_string(ws, ' ') as norm,
                 row_number() over (partition by doc_id order by pos) as k,
                 sum(len(ws)) over (partition by doc_id order by pos) as upto
          from l where len(ws) > 0),
        spans as (
          select a.doc_id, a.k as b, min(z.k) as e from s a join s z
            on a.doc_id = z.doc_id and z.k >= a.k and z.upto - a.upto + a.n >= {line_dedup.MIN_WORDS} group by all
          union
          select z.doc_id, max(a.k) as b, z.k as e from s a join s z
            on a.doc_id = z.doc_id and z.k >= a.k and z.upto - a.upto + a.n >= {line_dedup.MIN_WORDS} group by all),
        content as (
          select p.doc_id, p.b, p.e, string_agg(x.norm, chr(10) order by x.k) as c
          from spans p join s x on x.doc_id = p.doc_id and x.k between p.b and p.e group by all),
        later as (select * from content qualify row_number() over (partition by c order by doc_id, b) > 1),
        gone as (select distinct x.doc_id, x.pos, x.n from later p join s x
                 on x.doc_id = p.doc_id and x.k between p.b and p.e),
        kept as (select l.doc_id, string_agg(line, chr(10) order by pos) as text
                 from l anti join gone using (doc_id, pos) group by 1),
        counts as (select doc_id, count(*) as n_lines from s group by 1),
        cut as (select doc_id, count(*) as n_removed, sum(n) as words from gone group by 1)
        select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
               coalesce(words, 0)::bigint as words_removed,
               case when d.text is not null then sha256(coalesce(kept.text, '')) end as text_sha256
        from documents d left join counts using (doc_id) left join cut using (doc_id) left join kept using (doc_id)""",
    "op6_license_scan": _licence_sql(),
    "op7_exact_dedup": r"""
        with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                            as text_sha256 from documents),
        g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by 1)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
        from d join g using (text_sha256)""",
    "op11_filter_audit": rf"""
        with l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
                          max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by 1),
        t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
        d as (select t.doc_id, part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
                case when len(ws) < {filter_audit.LEAST_WORDS} then 'A' else '' end
                || case when 100 * len(list_distinct(ws)) < {filter_audit.LEAST_DISTINCT} * len(ws) then 'B' else '' end
                || case when 100 * len(regexp_extract_all(text, '[A-Z]')) > {filter_audit.MOST_CAPITALS} * length(text) then 'C' else '' end
                || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
                || case when min(t.doc_id) over (partition by text) < t.doc_id then 'E' else '' end as fails
              from t left join l using (doc_id)),
        g as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from d group by 1, 2),
        f as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
        o as (select a.x || b.x || c.x || d.x || e.x as filter_order from f a, f b, f c, f d, f e
              where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s as (select filter_order, step, substr(filter_order, step::int, 1) as x, substr(filter_order, 1, step::int - 1) as before
              from o, range(1, 6) as r(step)),
        every as (
          select part, filter_order, step, x, n, good, toxic, contains(fails, x) as own, fails = x as alone,
                 len([y for y in string_split(before, '') if y <> '' and contains(fails, y)]) > 0 as earlier
          from g, s),
        sums as (
          select part, filter_order, step, x,
                 sum(case when not own and not earlier then n else 0 end) as kept,
                 sum(case when own and not earlier then n else 0 end) as removed,
                 sum(case when own and earlier then n else 0 end) as redundant,
                 sum(case when alone then n else 0 end) as unique_fails,
                 sum(case when own and not earlier then good else 0 end) as good_lost,
                 sum(case when own and not earlier then toxic else 0 end) as toxic_lost
          from every group by 1, 2, 3, 4)
        select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
               redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
               toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, x))::bigint as shapley
        from sums""",
    "op12_hard_negatives": rf"""
        with v as (
          select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                 [floor({hard_negatives.SCALE} * x::double)::bigint for x in embedding] as q
          from embeddings
          where vec_id is not null and label is not null and embedding is not null
            and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        s as (
          select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label,
                 list_sum([z[1] * z[2] for z in list_zip(a.q, b.q)])::bigint as score
          from v a, v b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
        p as (select anchor_id, vec_id as positive_id, score as positive_score from s where label = own
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {hard_negatives.POSITIVES})
        select anchor_id, positive_id,
               (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
               vec_id as negative_id, positive_score, score as negative_score
        from p join s using (anchor_id)
        where label <> own and {hard_negatives.LEAST} * positive_score <= 100 * score
          and 100 * score <= {hard_negatives.MOST} * positive_score
        qualify rank <= {hard_negatives.NEGATIVES}""",
}

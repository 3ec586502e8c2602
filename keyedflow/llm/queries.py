"""The query of each operator, over the whole of its table, and its SQL where SQL can express it."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, centroids, decontam, extract, line_dedup, lm, packing, quality, resample, sharding, simhash, tokenfile, toxicity
from .common import residue, stored, table

QUERIES, ORACLE = {}, {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _u32_count(ids: str):
    return F.expr(f"cast(octet_length({ids}) div 4 as bigint)")


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they stand for, as counts and digests."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded="decoded")
    return both.select(
        "doc_id", _u32_count("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the lines that three or more documents share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.line_dedup(docs)
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


ORACLE["op10_line_dedup"] = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) pos
  from documents
), keyed as (
  select doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k
  from lines
), shared as (
  select k, max(doc_id) keeper from keyed where length(k) >= 20
  group by k having count(distinct doc_id) >= 3
), marked as (
  select doc_id, pos, line, coalesce(doc_id <> keeper, false) gone from keyed left join shared using (k)
)
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
"""


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight and its place there, equal texts together."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    )
    return sharding.assign(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures, the base rule and the verdict with its host's record."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = stored(quality.measure(docs).drop("text"), "measures")
    return quality.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@_query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest document that it is linked with."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prints = stored(simhash.fingerprints(docs), "prints")
    return simhash.classes(prints).select(
        "doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id"
    )


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside windows of benchmark items, and those items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_matches(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    found = found.select("doc_id", "n_words", decontam.n_hit().alias("n_hit"), decontam.items().alias("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the id files, read back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    files = tokenfile.write_ids(docs, vocabulary, public_tokenizers.PATTERN, end_id=2)
    return tokenfile.read_ids(files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@_query
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the backoff model and by unigrams."""
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's calibrated toxicity score, learned from the labels of the training fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(residue("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return scorer.score(docs).select("doc_id", held_out, "score", "predicted")


@_query
def op2_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op4_decontamination"] = rf"""
with d as (
  select doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents
), b as (
  select item_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark
), win as (
  select distinct cast(item_id as varchar) item, least(len(w), 10) l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') k
  from (select *, unnest(generate_series(1, greatest(len(w) - 9, 1))) i from b where len(w) > 0)
), dw as (
  select doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') k from (
    select doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) p
    from d, (select distinct l from win) where len(w) >= l)
), hit as (
  select doc_id, p, l, item from dw join win using (l, k)
), pos as (
  select doc_id, count(distinct q) n from (select doc_id, unnest(generate_series(p, p + l - 1)) q from hit) group by 1
), it as (
  select doc_id, count(distinct item) n, string_agg(distinct item, ',' order by item) s from hit group by 1
)
select doc_id, len(w) n_words, coalesce(pos.n, 0) n_hit, coalesce(it.n, 0) n_items,
  sha256(coalesce(it.s, '')) items_sha256, coalesce(pos.n, 0) > 0 contaminated
from d left join pos using (doc_id) left join it using (doc_id)
"""

_RULES = tuple(quality.RULE_NAMES)

ORACLE["op5_host_quality"] = rf"""
with d as (
  select doc_id, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents
), line as (
  select doc_id, l, count(*) n from (select doc_id, unnest(string_split(t, chr(10))) l from d) group by 1, 2
), dup as (
  select doc_id, sum(n) n_lines, sum(case when regexp_matches(l, '[^\x20\x09-\x0D]') then n - 1 else 0 end) n_dup from line group by 1
), win as (
  select doc_id, i, count(*) over (partition by doc_id, k) n from (
    select doc_id, unnest(generate_series(1, len(w) - 2)) i,
      unnest([array_to_string(w[x:x + 2], ' ') for x in generate_series(1, len(w) - 2)]) k
    from d)
), rep as (
  select doc_id, count(distinct q) n_rep from (select doc_id, unnest([i, i + 1, i + 2]) q from win where n > 1) group by 1
), m as (
  select d.doc_id, source, len(w) n_words, cast(coalesce(list_sum([length(x) for x in w]), 0) as bigint) word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) n_symbols, n_lines, cast(n_dup as bigint) n_dup_lines, coalesce(n_rep, 0) n_repeat_words
  from d join dup using (doc_id) left join rep using (doc_id)
), r as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base, 10 * n_symbols > n_words symbols,
    10 * n_dup_lines > 3 * n_lines duplicate_lines, word_chars < 3 * n_words or word_chars > 15 * n_words word_length
  from m
), h as (
  select source, count(*) n, {", ".join(f"count(*) filter ({x}) f_{x}" for x in _RULES)} from r group by source
), s as (
  select count(*) k, sum(n) n, sum(cast(n as double) * n) sq,
    {", ".join(f"sum(f_{x}) f_{x}, sum(cast(f_{x} as double) * f_{x} / n) s_{x}" for x in _RULES)} from h
), prior as (
  select {", ".join(
      f"f_{x} / n mean_{x}, case when f_{x} in (0, n) then 1.0 else 1 / least(greatest("
      f"(s_{x} - f_{x} * f_{x} / n - f_{x} / n * (1 - f_{x} / n) * (k - 1)) / greatest("
      f"f_{x} / n * (1 - f_{x} / n) * (n - sq / n - (k - 1)), 1e-9), 1 / 1001.0), 0.5) - 1 end g_{x}" for x in _RULES)}
  from s
), rate as (
  select source, {", ".join(f"(f_{x} + mean_{x} * g_{x}) / (n + g_{x}) rate_{x}" for x in _RULES)} from h, prior
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base base_failed,
  not base and not (rate_base > {quality.BLOCKED}
    {" ".join(f"or ({x} and rate_{x} > {quality.DISTRUSTED})" for x in _RULES if x != "base")}) kept
from r join rate on r.source is not distinct from rate.source
"""


@_query
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after ten rounds, with the figures of its cluster."""
    return centroids.with_clusters(centroids.cluster(table(spark, sf_dir, "embeddings")))


_DISTANCE = "list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _near(centres: str) -> str:
    """Each vector with its least (distance, cluster) among the rows of a CTE (n, v)."""
    return f"""select e.vec_id, e.v, e.row, min({{'d': cast({_DISTANCE} as bigint), 'n': c.n}}) near
        from e cross join {centres} c group by e.vec_id, e.v, e.row"""


def _lloyd(rounds: int) -> str:
    """The rounds written out. Components are summed by place; `s - ((s % n) + n) % n` makes the division a floor."""
    steps = []
    for i in range(rounds):
        steps.append(f"""near{i} as materialized ({_near(f"c{i}")}),
m{i} as (
  select n, list((s - ((s % k) + k) % k) // k order by i) v from (
    select near.n n, i, cast(sum(v[i]) as bigint) s, count(*) k
    from near{i}, (select unnest(range(1, 65)) i) group by all) group by n
), c{i + 1} as materialized (select n, coalesce(m{i}.v, c{i}.v) v from c{i} left join m{i} using (n)),
""")
    return "".join(steps)


ORACLE["op11_centroid_clusters"] = f"""
with e as materialized (
  select vec_id, row_number() over () as row, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) v
  from embeddings
  where len(embedding) = 64 and list_count(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 as materialized (
  select row_number() over (order by sha256('3:' || vec_id), v) - 1 n, v from e
  qualify row_number() over (order by sha256('3:' || vec_id), v) <= 8
),
{_lloyd(10)} last as materialized ({_near("c10")}),
f as (select near.n n, sum(near.d) inertia from last group by 1)
select vec_id, cast(near.n as int) "cluster", near.d distance, cast(f.inertia as bigint) cluster_inertia,
  cast((select sum(inertia) from f) as bigint) inertia, sha256(array_to_string(c10.v, ',')) centroid_sha256
from last join f on f.n = near.n join c10 on c10.n = near.n
"""


@_query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's text, its noisy score and its place in the draw."""
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resample.resample(docs, target)


@_query
def op13_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, and its place in a sequence."""
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=0)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

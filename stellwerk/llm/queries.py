"""One query for each operator of this package, over a whole table of the benchmark."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellwerk.llm import bitslice, bpe, covertree, fixity, hmm, infill, jaccard, langid, mixing, periodic, pii, substrings, urls
from stellwerk.llm.common import WORD, at_workers, fold

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return at_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihood of every text under a hidden Markov model and under word frequencies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", fold("doc_id", 10) == 0)
    return hmm.scored(docs, "not held_out")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.tokenized(docs, VOCABULARY, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replaced(docs).select("doc_id", "n_replaced", "text")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from three quarters of the labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", fold("doc_id", 4) == 2)
    model = langid.fit(docs.where("not held_out"))
    return langid.identified(docs, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document, and when it takes it first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.read(docs).select("doc_id", "size", "source_size", "target", "taken", "times", "position")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label."""
    vectors = covertree.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)
    return vectors.select("vec_id", "n_links", "component_id", "kept")


def op7_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage of a replica of all pages, of which some records are changed, lost or doubled."""
    pages = table(spark, sf_dir, "pages")
    replica = pages.where("page_id % 97 <> 3").withColumn(
        "html", F.when(F.col("page_id") % 89 == 5, F.concat("html", F.lit(" "))).otherwise(F.col("html"))
    )
    replica = replica.unionByName(pages.where("page_id % 101 = 7"))
    return fixity.audited(fixity.records(pages), fixity.records(replica))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by the Jaccard similarity of their word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.grouped(docs)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = urls.judged(pages, urls.SITES + urls.METHOD)
    return found.select("page_id", "host", "path", urls.rule_of(F.col("rule")).alias("rule"), "verdict")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors for every hundredth vector."""
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", 10)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Texts of which a tenth, by the crc32 of the doc_id, end in a repeated stretch of their words."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    docs = docs.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.floor(h / 10))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    docs = docs.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    cycle = F.slice("words", F.col("a") + 1, F.least("p", rest))
    tail = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, the longest of them, and the text without what they repeat."""
    docs = with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.with_runs(docs).withColumn("longest", periodic.longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a fill-in-the-middle sample, and restored from it, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = infill.transformed(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the passages of 13 words or more that an earlier document has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substrings.without_repeats(docs)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_score, op2_bpe, op3_pii_surrogates, op4_language, op5_mixing, op6_near_vectors,
        op7_fixity_audit, op8_ngram_jaccard, op9_url_filter, op10_top_k, op11_periodic_runs,
        op12_fill_in_middle, op13_substring_dedup,
    )
}

WORDS_OF = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = rf"""
with rows as (
  select doc_id, source, coalesce(len({WORDS_OF.format("text")}), 0)::bigint as size,
    md5(coalesce(source, '') || '|' || coalesce(doc_id::varchar, '')) as turn
  from documents),
sources as (select source, sum(size)::bigint as source_size from rows group by source),
weighed as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 0.6::double when 1 then 0.0::double else -0.6::double end as slope
  from sources),
ranked as (
  select *, 1.5::double * sum(source_size) over () as total,
    coalesce(sum(2 * source_size) over (order by source_size::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::double as limits,
    (sum(weight) over () - coalesce(sum(weight) over (order by source_size::double / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double as weights
  from weighed),
capped as (select *, 2 * source_size <= (total - limits) * weight / weights as at_limit from ranked),
rate as (select min(total) as total, max(limits) as limits, max(weights) as weights from capped where not at_limit and limits = (select min(limits) from capped where not at_limit)),
targets as (
  select c.source, c.source_size, c.slope,
    case when c.at_limit then (2 * c.source_size)::double else (r.total - r.limits) * c.weight / r.weights end as target
  from capped c left join rate r on true),
placed as (
  select r.doc_id, r.size, t.source_size, t.target, t.slope,
    (coalesce(sum(r.size) over (partition by r.source order by r.turn, r.size rows between unbounded preceding and 1 preceding), 0))::bigint as start
  from rows r join targets t on r.source is not distinct from t.source),
taken as (
  select *, greatest(0, least(size, floor(target)::bigint - start))::bigint as first_words,
    greatest(0, least(size, floor(target)::bigint - start - source_size))::bigint as second_words,
    least(1.0, start / greatest(target, 1.0)) as share
  from placed)
select doc_id, size, source_size, target, first_words + second_words as taken,
  (case when first_words > 0 or size = 0 then 1 else 0 end + case when second_words > 0 then 1 else 0 end)::int as times,
  case when first_words > 0 or size = 0 then
    case when slope = 0 then share else (sqrt(pow(1 - slope, 2) + 4 * slope * share) - (1 - slope)) / (2 * slope) end
  end as position
from taken
"""

OP6 = """
with recursive usable as (
  select vec_id, label, embedding::double[] as x from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
    and len(list_filter(embedding, lambda v: v <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.98),
reached as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
lowest as (select a, min(b) as b from reached group by a),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(c.n, 0)::bigint as n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) as kept
from embeddings e left join lowest l on e.vec_id = l.a left join counts c on e.vec_id = c.a
"""

RECORD = (
    "'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') "
    "|| chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) "
    "|| coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"
)
OP7 = f"""
with damaged as (
  select page_id, url, case when page_id % 89 = 5 then html || ' ' else html end as html from pages where page_id % 97 <> 3
  union all select page_id, url, html from pages where page_id % 101 = 7),
records as (
  select 0 as side, page_id // 4096 as file, page_id % 4096 as slot, sha256({RECORD}) as digest, strlen({RECORD})::bigint as length from pages
  union all
  select 1, page_id // 4096, page_id % 4096, sha256({RECORD}), strlen({RECORD})::bigint from damaged),
numbered as (select *, (row_number() over (partition by side, file, slot order by digest) - 1)::int as copy from records),
placed as (
  select *, coalesce(sum(length) over (partition by side, file order by slot, copy rows between unbounded preceding and 1 preceding), 0)::bigint as "offset"
  from numbered),
l as (select * from placed where side = 0), r as (select * from placed where side = 1)
select file, slot, copy, coalesce(l."offset", r."offset") as "offset", coalesce(l.length, r.length) as length,
  l.digest as expected, r.digest as found,
  case when l.digest is null then 'surplus' when r.digest is null then 'missing' else 'corrupt' end as status
from l full join r using (file, slot, copy) where l.digest is distinct from r.digest
"""

OP8 = rf"""
with recursive words as (select doc_id, {WORDS_OF.format(LOWERED.format("text"))} as w from documents),
shingled as (
  select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words),
sizes as (select doc_id, len(s)::bigint as n from shingled),
entries as (select doc_id, unnest(s) as x from shingled),
met as (select a.doc_id as a, b.doc_id as b, count(*) as n from entries a join entries b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select o.a, o.b from met o join sizes p on o.a = p.doc_id join sizes q on o.b = q.doc_id where 100 * o.n >= 80 * (p.n + q.n - o.n)),
reached as (select a, b from links union select r.a, l.b from reached r join links l on r.b = l.a),
lowest as (select a, min(b) as b from reached group by a)
select s.doc_id, s.n as n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) as component_id
from sizes s left join lowest l on s.doc_id = l.a
"""

OP9 = rf"""
with rest as (
  select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, url, {LOWERED.format("regexp_extract(rest, '^[^/?#]*')")} as host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from rest),
ruled as (
  select *, case
    when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule
  from parts)
select page_id, host, path, rule, case
    when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
    when regexp_matches(host || path, '(?i)(^|[^0-9a-z_])(adserver|banner|casino|malware|phishing|porn|tracker|xxx)($|[^0-9a-z_])') then 'block'
    else 'allow' end as verdict
from ruled
"""

OP10 = """
with usable as (
  select vec_id, list_transform(embedding, lambda v: floor(1024 * v::double)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
scores as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scores qualify rank <= 10
"""

OP12 = r"""
with drawn as (
  select doc_id, coalesce(text, '') as x, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t
  from documents),
numbers as (
  select *, len(t)::bigint as n, ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
    ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from drawn),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h3 % 100 >= 50 then 'plain'
      when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from numbers),
parts as (
  select *, array_to_string(t[1:a], '') as prefix, array_to_string(t[a + 1:b], '') as middle, array_to_string(t[b + 1:n], '') as suffix from cut),
made as (
  select *, case form when 'plain' then x when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end as output
  from parts)
select doc_id, n, form, case when form <> 'plain' then length(prefix)::bigint end as prefix_chars,
  case when form <> 'plain' then length(middle)::bigint end as middle_chars, sha256(output) as output_sha256,
  sha256(case when form = 'plain' then output else prefix || middle || suffix end) as restored_sha256
from made
"""

OP13 = rf"""
with words as (select row_number() over () as r, doc_id, coalesce({WORDS_OF.format("text")}, []) as w from documents),
windows as (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from words where doc_id is not null and len(w) >= 13),
named as (select r, doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) as x from windows),
least as (select x, min(doc_id) as low from named group by x having count(*) > 1),
gone as (
  select distinct n.r, n.i + k.k as i from named n join least l on n.x = l.x and n.doc_id > l.low, (select unnest(range(0, 13)) as k) k),
lists as (select r, list(i) as g from gone group by r),
kept as (
  select doc_id, w, list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(coalesce(g, []), i)), lambda i: w[i]) as k
  from words left join lists using (r))
select doc_id, len(w)::bigint as n_words, (len(w) - len(k))::bigint as n_removed, sha256(coalesce(array_to_string(k, ' '), '')) as kept_sha256 from kept
"""

ORACLE = {
    "op5_mixing": OP5, "op6_near_vectors": OP6, "op7_fixity_audit": OP7,
    "op8_ngram_jaccard": OP8, "op9_url_filter": OP9, "op10_top_k": OP10, "op12_fill_in_middle": OP12,
    "op13_substring_dedup": OP13,
}

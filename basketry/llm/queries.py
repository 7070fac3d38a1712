"""The thin ``opN_<name>`` queries over the test tables, and their SQL.

Each applies one operator with its production parameters to the whole table
and derives the columns its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import centroids
from basketry.llm.alignment import alignment
from basketry.llm.centroids import centroid_clustering
from basketry.llm.chosen_path import PERCENT, chosen_path_dedup
from basketry.llm.common import crc_mod
from basketry.llm.decontamination import contamination
from basketry.llm.exact_dedup import exact_dedup
from basketry.llm.language_id import language_id, prototypes
from basketry.llm.line_dedup import LONG_MIN_SITES, LONG_WORDS, MIN_SITES, line_dedup
from basketry.llm.lm_scoring import lm_scores
from basketry.llm.packing import pack
from basketry.llm.quality import quality_scores, train
from basketry.llm.simhash import near_dedup
from basketry.llm.token_counts import token_counts
from basketry.llm.url_filter import (
    MAX_BAD_RATE, MAX_RHO, MIN_RHO, NO_RHO, TWO_LABEL_SUFFIXES, Z, url_filter)

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned text as a digest, with the lines it had and lost."""
    found = line_dedup(table(spark, sf_dir, "documents"), counts=True)
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_removed",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even hashes of the id make up the snapshot, the others the new batch."""
    old = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return exact_dedup(table(spark, sf_dir, "documents"), old).drop("in_snapshot")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 5) == 0
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return (quality_scores(docs, model)
            .select("doc_id", held_out.alias("held_out"), "score", "predicted"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is bad if the label of its id says low quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    outcomes = (pages.select("page_id", "url")
                .join(labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad")), "page_id"))
    return url_filter(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = prototypes(docs.where(~held_out))
    return language_id(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering(table(spark, sf_dir, "embeddings"))


def op12_chosen_path_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path_dedup(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                      public_tokenizers.path(PIECES))
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_decontamination, op3_line_dedup, op4_exact_dedup, op5_lm_scoring,
        op6_quality, op7_url_filter, op8_language_id, op9_token_counts, op10_packing,
        op11_centroid_clustering, op12_chosen_path_dedup, op13_token_alignment)
}


# ---- SQL ------------------------------------------------------------------------

def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    lower = _lower(f"coalesce({text}, '')")
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _level(name: str) -> str:
    """Prior strength of a level, from its table ``(n, bad)``."""
    return f"""
        {name}_k as (select case when n > 0 then (1 - rho) / rho else {(1 - NO_RHO) / NO_RHO!r} end as k from (
            select n, case when below > 0 then least({MAX_RHO}, greatest({MIN_RHO},
                       (rr - bad * bad / n - mu * (1 - mu) * (k - 1)) / below)) else {NO_RHO} end as rho
            from (select *, bad / n as mu, bad / n * (1 - bad / n) * (n - nn / n - (k - 1)) as below
                  from (select sum(n)::double as n, sum(bad)::double as bad, count(*)::double as k,
                               sum(n::double * n) as nn, sum(bad::double * bad / n) as rr from {name}))))"""


def _clustering() -> str:
    """Every round spelt out: the nearest centroid per vector, then the floors of the means."""
    steps = []
    for r in range(centroids.ROUNDS + 1):
        steps.append(f"""
        a{r} as materialized (
            select r, (min((s, c)))[2] as c, (min((s, c)))[1] as s from (
                select r, c, sum((x - y) * (x - y))::bigint as s from e join c{r} using (d) group by r, c)
            group by r)""")
        if r < centroids.ROUNDS:
            steps.append(f"""
        c{r + 1} as materialized (
            select c, d, coalesce((s - ((s % n) + n) % n) // n, y) as y from c{r} left join (
                select c, d, sum(x)::bigint as s, count(*) as n from a{r} join e using (r) group by c, d)
            using (c, d))""")
    last = centroids.ROUNDS
    return f"""
        with kept as materialized (
            select row_number() over () as r, vec_id, embedding as v from embeddings
            where len(embedding) = {centroids.DIM} and len([x for x in embedding if isfinite(x)]) = {centroids.DIM}),
        e as materialized (
            select r, d, floor({centroids.SCALE} * x::double)::bigint as x
            from (select r, unnest(v) as x, generate_subscripts(v, 1) as d from kept)),
        seeds as (select r, row_number() over (order by sha256('{centroids.SEED}:' || coalesce(vec_id::varchar, '')), v)
                         - 1 as c from kept qualify c < {centroids.K}),
        c0 as materialized (select c, d, x as y from seeds join e using (r)),{",".join(steps)},
        own as (select c, sum(s)::bigint as cluster_inertia from a{last} group by c),
        digest as (select c, sha256(string_agg(y::varchar, ',' order by d)) as centroid_sha256
                   from c{last} group by c)
        select vec_id, c::integer as cluster, s as distance, cluster_inertia,
               (select sum(s)::bigint from a{last}) as inertia, centroid_sha256
        from kept join a{last} using (r) join own using (c) join digest using (c)"""


def _domain_and_suffix(host: str) -> str:
    """The registered domain and the public suffix of a host, as two columns."""
    two = f"array_to_string(string_split({host}, '.')[-2:], '.')"
    three = f"array_to_string(string_split({host}, '.')[-3:], '.')"
    listed = f"{two} in ({', '.join(repr(x) for x in TWO_LABEL_SUFFIXES)})"
    return (f"case when {listed} then {three} else {two} end as domain, "
            f"case when {listed} then {two} else string_split({host}, '.')[-1] end as suffix")


ORACLE_SQL: dict[str, str] = {
    "op11_centroid_clustering": _clustering(),
    # pairs that share a shingle, counted; a pair under the size bound can't link
    "op12_chosen_path_dedup": f"""
        with recursive d as materialized (
            select row_number() over () as r, doc_id,
                   regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from documents),
        s as materialized (
            select r, case when len(w) = 0 then [] when len(w) = 1 then w
                      else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as g
            from d),
        e as materialized (select r, len(g) as n, hash(x) as h from (select r, g, unnest(g) as x from s)),
        links as materialized (
            select a.r as u, b.r as v from e a join e b on a.h = b.h and a.r <> b.r
                and 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
            group by a.r, b.r, a.n, b.n having 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
        reach as (select u, v from links union select reach.u, links.v from reach join links on reach.v = links.u),
        lowest as (select u as r, min(doc_id) as low from reach join d on d.r = reach.v group by u)
        select d.doc_id, len(g)::bigint as n_shingles, least(d.doc_id, low) as component_id,
               d.doc_id is not distinct from least(d.doc_id, low) as kept
        from d join s using (r) left join lowest using (r)""",
    "op2_decontamination": f"""
        with d as (select row_number() over () as r, doc_id, {_words("text")} as w from documents),
        b as (select item_id, {_words("text")} as w from benchmark),
        bw as (select distinct item_id, n, array_to_string(w[s:s + n - 1], ' ') as g
               from (select item_id, w, least(10, len(w)) as n,
                            unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s
                     from b where len(w) > 0)),
        dw as (select r, s, n, array_to_string(w[s:s + n - 1], ' ') as g
               from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s
                     from d, (select distinct n from bw) where len(w) >= n)),
        hits as (select r, s, n, item_id from dw join bw using (n, g)),
        inside as (select r, count(distinct p) as n_hit
                   from (select r, unnest(range(s, s + n)) as p from (select distinct r, s, n from hits))
                   group by r),
        listed as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
                   from (select distinct r, item_id::varchar as item from hits) group by r)
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
               n_hit is not null as contaminated
        from d left join inside using (r) left join listed using (r)""",
    "op3_line_dedup": f"""
        with l as (select doc_id, source, unnest(string_split(text, chr(10))) as line,
                          generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
        k as (select *, trim(line, ' ' || chr(9) || chr(13)) as key from l),
        bad as (select key, min((doc_id, pos)) as first from k where key <> ''
                group by key having count(distinct source) >= case when len(regexp_split_to_array(
                    key, '[ \\t\\r]+')) >= {LONG_WORDS} then {LONG_MIN_SITES} else {MIN_SITES} end),
        j as (select doc_id, pos, line, first is not null and (doc_id, pos) <> first as gone
              from k left join bad using (key)),
        c as (select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
                     string_agg(line, chr(10) order by pos) filter (not gone) as text
              from j group by doc_id)
        select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
               sha256(coalesce(c.text, '')) as text_sha256
        from documents left join c using (doc_id)""",
    "op4_exact_dedup": f"""
        with d as (select doc_id, sha256({_lower("coalesce(text, '')")}) as text_sha256
                   from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, text_sha256
        from d window w as (partition by text_sha256)""",
    "op7_url_filter": f"""
        with r as (select page_id, case when position('://' in coalesce(url, '')) > 0
                          then substr(url, position('://' in url) + 3) else '' end as rest from pages),
        p as (select page_id, {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} as host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
        o as (select host, count(*) as n,
                     count(*) filter (coalesce(quality = 0, false) or coalesce(toxic = 1, false)) as bad
              from p join labels on page_id = doc_id group by host),
        h as (select *, {_domain_and_suffix("host")} from o),
        s as (select suffix, sum(n) as n, sum(bad) as bad from h group by suffix),
        dm as (select domain, sum(n) as n, sum(bad) as bad from h group by domain),
        {_level("s")}, {_level("dm")}, {_level("h")},
        a as (select coalesce(sum(bad) / sum(n), 0) as overall from h),
        every as (select host, {_domain_and_suffix("host")} from (select distinct host from p)),
        m as (select every.host, coalesce(h.n, 0) as n, h_k.k as k,
                     (h_k.k * ((dm_k.k * ((s_k.k * overall + coalesce(s.bad, 0)) / (s_k.k + coalesce(s.n, 0)))
                                + coalesce(dm.bad, 0)) / (dm_k.k + coalesce(dm.n, 0)))
                      + coalesce(h.bad, 0)) / (h_k.k + coalesce(h.n, 0)) as rate
              from every left join s on every.suffix = s.suffix left join dm on every.domain = dm.domain
                   left join h on every.host = h.host, s_k, dm_k, h_k, a),
        v as (select host, case when rate - {Z} * sqrt(rate * (1 - rate) / (k + n + 1)) > {MAX_BAD_RATE}
                           then 'block' else 'allow' end as own from m),
        rules as (select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rh, rp, says)),
        f as (select page_id, rh || rp as rule, says from p join rules
              on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
              qualify row_number() over (partition by page_id order by len(rh || rp) desc) = 1)
        select page_id, host, path, rule, coalesce(says, own) as verdict
        from p left join f using (page_id) left join v using (host)""",
}

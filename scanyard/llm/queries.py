"""One registered query per operator: the operator over its whole table and the columns its
contract asks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard.llm import (
    decontaminate, divergence, exact_dedup, html_text, line_dedup, ngram_join, packing,
    periodic_runs, pseudo_likelihood, token_files, toxicity, url_rules, warc)
from scanyard.llm.common import table
from scanyard.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)
        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return run
    return register


# Lower-casing of A-Z alone, in the comparison SQL.
_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
    with t as (select doc_id, {_AZ.format("coalesce(text, '')")} as norm from documents),
    g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
    select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept,
           sha256(t.norm) as text_sha256
    from t join g on t.norm = g.norm""")
def op2_exact_dedup(spark, sf_dir):
    """Equal texts, of which the largest doc_id stays."""
    return exact_dedup.groups(table(spark, sf_dir, "documents"), largest=True).withColumnRenamed(
        "id", "doc_id")


@query()
def op5_packing(spark, sf_dir):
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


_WORDS6 = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(f"""
    with d as (select doc_id, {_WORDS6.format(_AZ.format("coalesce(text, '')"))} as w
               from documents),
    b as (select item_id, {_WORDS6.format(_AZ.format("coalesce(text, '')"))} as w from benchmark),
    windows as (
        select distinct cast(item_id as varchar) as item, least(10, len(w)) as n,
               array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as words
        from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
              from b where len(w) > 0)),
    sizes as (select distinct n from windows),
    places as (
        select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as words
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p
              from d, sizes where len(w) >= n)),
    finds as (select doc_id, places.n, p, item from places join windows
              on places.n = windows.n and places.words = windows.words),
    hit as (select doc_id, count(distinct q) as n_hit
            from (select doc_id, unnest(range(p, p + n)) as q
                  from (select distinct doc_id, n, p from finds)) group by doc_id),
    items as (select doc_id, count(distinct item) as n_items,
                     string_agg(distinct item, ',' order by item) as items
              from finds group by doc_id)
    select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit,
           coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
           n_hit is not null as contaminated
    from d left join hit on hit.doc_id = d.doc_id left join items on items.doc_id = d.doc_id""")
def op6_decontamination(spark, sf_dir):
    """Words of documents inside windows of the benchmark."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_join("items", ",").cast("binary")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op10_token_files(spark, sf_dir):
    """All documents as ids in files, read back."""
    docs = table(spark, sf_dir, "documents")
    folder = token_files.new_folder(docs)
    read = token_files.read(token_files.write(docs, folder), folder)
    return read.select(F.col("id").alias("doc_id"), "start",
                       (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@query()
def op7_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                         toxicity.score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("""
    with recursive d as (
        select doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
        from documents),
    s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g
          from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i
                from d where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    o as (select a.doc_id as a, b.doc_id as b, count(*) as o
          from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
    l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b
          where 100 * o >= 85 * (x.n + y.n - o)),
    e as (select a, b from l union select b, a from l),
    reach as (select doc_id as a, doc_id as b from documents
              union select reach.a, e.b from reach join e on e.a = reach.b)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
    from d left join n on n.doc_id = d.doc_id
    join (select a, min(b) as component_id from reach group by a) c on c.a = d.doc_id""")
def op1_ngram_join(spark, sf_dir):
    """Near copies by sets of four words."""
    return ngram_join.near_groups(table(spark, sf_dir, "documents"), n=4, threshold=85) \
        .withColumnRenamed("id", "doc_id").withColumn("n_shingles", F.col("n_shingles").cast("long"))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query("""
    with u as (
        select page_id, case when position('://' in url) > 0
               then substr(url, position('://' in url) + 3) else '' end as rest from pages),
    p as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
    h as (select page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz') as host from p),
    rules(rule_host, rule_path, verdict) as (values
        ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    f as (select page_id, rule_host || rule_path as rule, verdict, row_number() over (
              partition by page_id order by length(rule_host || rule_path) desc) as nth
          from h join rules on starts_with(path, rule_path)
           and (host = rule_host or ends_with(host, '.' || rule_host)))
    select h.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
    from h left join f on f.page_id = h.page_id and nth = 1""")
def op8_url_rules(spark, sf_dir):
    """Verdicts of nested host and path rules."""
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, RULES)) \
        .withColumnRenamed("id", "page_id")


@query("""
    with p as (select page_id, coalesce(html, '') as html from pages),
    d as (select page_id, octet_length(encode(html)) as n, sha1(html) as sha from p),
    g as (select sha, max(page_id) as head from d where n >= 1000 group by sha)
    select page_id, n as payload_bytes, d.sha as payload_digest,
           case when page_id <> head then 'revisit' else 'response' end as record_type,
           case when page_id <> head then head end as refers_to
    from d left join g on g.sha = d.sha and d.n >= 1000""")
def op4_warc(spark, sf_dir):
    """Pages written as archives and read back."""
    pages = table(spark, sf_dir, "pages")
    folder = warc.new_folder(pages)
    read = warc.read(warc.write(pages, folder), folder).where("gap is null")
    kind = pages.schema["page_id"].dataType
    return read.select(
        warc.page_id(F.col("record_id")).cast(kind).alias("page_id"), "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"), F.col("type").alias("record_type"),
        warc.page_id(F.col("refers_to")).cast(kind).alias("refers_to"))


@query()
def op3_html_text(spark, sf_dir):
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text",
                        F.length("text").cast("long").alias("n_chars"))


@query()
def op9_lm_scoring(spark, sf_dir):
    """Log-likelihood of every document's words, each given those on both sides."""
    docs = table(spark, sf_dir, "documents")
    return pseudo_likelihood.fit_and_score(docs).withColumnRenamed("id", "doc_id")


def planted(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten by its id repeats some of its words up to its end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    given = docs.select("doc_id", "text", F.floor(h / 10).alias("g"),
                        F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    placed = given.select("doc_id", "text", "g", "words", F.when(n > 0, F.col("g") % n).alias("a"))
    period = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    placed = placed.withColumn("p", period)
    source = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", F.when(
        i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(source, " "))
                         .otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark, sf_dir):
    """Runs of periodic words of every document, the strongest one, and digests."""
    found = periodic_runs.find(planted(table(spark, sf_dir, "documents")))
    # Exact: lengths over periods are compared by products.
    stronger = F.array_sort("runs", lambda a, b: F.when(
        a["length"] * b["period"] != b["length"] * a["period"],
        F.signum(b["length"] * a["period"] - a["length"] * b["period"]))
        .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
        .otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    best = found.withColumn("best", F.get(stronger, F.lit(0)))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n")))
    return best.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query(f"""
    with d as (select row_number() over () as i, coalesce(lang, '') as lang,
                      coalesce(source, '') as source, regexp_extract_all(
                          {_AZ.format("coalesce(text, '')")},
                          '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
    t as (select i, lang, source, unnest(w) as term from d),
    kept as (select lang, term, count(*) as n from t group by lang, term
             having count(distinct i) >= 30),
    v as (select lang, count(*) as v, sum(n) as n from kept group by lang),
    groups as (select distinct lang, source from d),
    own as (select lang, source, term, count(*) as c from t semi join kept using (lang, term)
            group by all),
    total as (select lang, source, sum(c) as n from own group by all),
    p as (select groups.lang, groups.source, kept.term, coalesce(own.c, 0) as c,
                 1 + (1000000000::hugeint * (coalesce(own.c, 0) + 5))
                     // (coalesce(total.n, 0) + 5 * v.v) as p,
                 1 + (1000000000::hugeint * (kept.n + 5)) // (v.n + 5 * v.v) as q
          from groups join kept on kept.lang = groups.lang join v on v.lang = groups.lang
          left join own on own.lang = groups.lang and own.source = groups.source
                       and own.term = kept.term
          left join total on total.lang = groups.lang and total.source = groups.source),
    sums as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
             from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source
             group by all),
    pair as (select a.lang, a.source, 'pair' as part, b.source as item,
                    coalesce(sums.value, 0)::bigint as value
             from groups a join groups b on a.lang = b.lang and a.source <> b.source
             left join sums on sums.lang = a.lang and sums.source = a.source
                           and sums.item = b.source),
    term as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value
             from p where c > 0 and p > q),
    every as (select * from pair union all select * from term)
    select *, (row_number() over (partition by lang, source, part
                                  order by value desc, item))::int as rank
    from every qualify part = 'pair' or rank <= 50""")
def op12_source_divergence(spark, sf_dir):
    """Distances of the sources of each language, and the terms that set a source apart."""
    audit = divergence.Audit(table(spark, sf_dir, "documents"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = audit.pairs().withColumn("part", F.lit("pair")).withColumnRenamed("other", "item")
    term = audit.terms(most=50).withColumn("part", F.lit("term")).withColumnRenamed("term", "item")
    return pair.select(columns).unionByName(term.select(columns))


@query(f"""
    with d as (select doc_id, coalesce(text, '') as text from documents),
    l as (select doc_id, pos, line, {_AZ.format("trim(line, ' ' || chr(9) || chr(10) || chr(11)"
                                                " || chr(12) || chr(13))")} as key
          from (select doc_id, unnest(string_split(text, chr(10))) as line,
                       generate_subscripts(string_split(text, chr(10)), 1) as pos from d)),
    first as (select key, min(doc_id) as first from l where length(key) >= 10 group by key),
    m as (select l.*, coalesce(first.first <> doc_id, false) as lost
          from l left join first on first.key = l.key)
    select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), ''))
               as kept_sha256
    from m group by doc_id""")
def op13_line_dedup(spark, sf_dir):
    """Documents without the lines that an earlier document holds."""
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.apply(docs, line_dedup.bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

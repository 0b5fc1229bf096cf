"""One query per operator over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from schemelens.llm import (byte_bpe, chat, embedding_dedup, fill_middle, language, minhash_dedup, packing, pii,
                            quality_model, quality_rules, spelling, suffix_dedup, url_filter)
from schemelens.llm.common import Scratch

GOOD = 0.7
RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
         url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
         url_filter.Rule("block", "net", "/fr/")]
#: Shortest word of the vocabulary, occurrences it needs, and one in so many (document, run) that loses a letter.
LEAST_CHARS = 7
LEAST_COUNT = 2
ONE_IN = 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, of: int, which: int) -> Column:
    """crc32 of the id as text leaves ``which``; false for a missing id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % of == which, F.lit(False))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(ids, path, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = Scratch(spark, "quality").keep(quality_model.measure(table(spark, sf_dir, "documents")))
    held_out = fold("doc_id", 4, 2)
    model = quality_model.fit(features.where(~held_out), table(spark, sf_dir, "labels"))
    return quality_model.score(features, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))],
                                    "conv_id long, turn long, role string, text string")
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    rows = said.unionByName(planted).withColumn("place", place)
    at = lambda i: F.struct(F.col("conv_id").alias("conv_id"), i.alias("place"))
    nodes = rows.select(at(F.col("place")).alias("node_id"),
                        F.when(F.col("place") > 1, at(F.col("place") - 1)).alias("parent_id"), "role", "text",
                        F.length("text").cast("double").alias("score"))
    back = chat.read_back(chat.format_paths(nodes))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    lost = F.concat_ws("", "loss_texts")
    return back.select(F.col("root.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.concat_ws("", spoken), 256).alias("turns_sha256"),
                       F.length(lost).cast("long").alias("loss_chars"), F.sha2(lost, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = pii.KINDS[:4]

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select("doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in base),
                        F.sha2(joined(of(*base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3, 1)
    learned = language.learn(docs.where(~held_out))
    return language.predict(docs, learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fill_middle.parts()
    done = fill_middle.transform(table(spark, sf_dir, "documents")).withColumn("parts", parts)
    chars = lambda part: F.length(F.col("parts")[part]).cast("long").alias(f"{part}_chars")
    return done.select(F.col("row.doc_id").alias("doc_id"), "n", "form", chars("prefix"), chars("middle"),
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore(F.col("parts")), 256).alias("restored_sha256"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the letter runs of the texts, one in ONE_IN (document, run) with a letter less."""
    # shorter runs cannot give words, and a match cannot start inside a run
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[A-Za-z\u00C0-\u00FF]{{{LEAST_CHARS},}}"), F.lit(0))
    said = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    said = said.select("id", F.coalesce(lower, F.col("run")).alias("run"))
    said = said.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, shorter).otherwise(F.col("run"))
    counted = said.select(word.alias("word")).where(F.length("word") >= LEAST_CHARS).groupBy("word").agg(
        F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(vocabulary(table(spark, sf_dir, "documents"))).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_quality, op3_packing, op4_minhash, op5_embeddings, op6_chat,
                                   op7_suffix, op8_rules, op9_pii, op10_language, op11_fill_middle, op12_spelling,
                                   op13_urls)}

_COMPONENTS = """
  nodes as (select u as node from links union select v from links),
  reach as (select node, node as other from nodes
            union select r.node, e.other from reach r join (select u, v as other from links
                                                            union select v, u from links) e on e.u = r.other),
  comps as (select node, min(other) as component from reach group by node)"""

_ESCAPED = r"replace({0}, '\', '\\')"
for _c in chat.CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}" + "\\" + f"{_c[1:]}')"
_MARKS = len(chat.TURN) + len(chat.TEXT) + len(chat.END)

ORACLES = {
    "op4_minhash": """
with recursive docs as (
  select doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] as w from documents),
  shingles as (
  select distinct doc_id, case when len(w) < 4 then w else w[i:i + 3] end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from docs where len(w) > 0)),
  sizes as (select doc_id, count(*) as n from shingles group by doc_id),
  common as (select a.doc_id as u, b.doc_id as v, count(*) as n from shingles a join shingles b
             on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
  links as (select u, v from common join sizes a on a.doc_id = u join sizes b on b.doc_id = v
            where 100 * common.n >= 80 * (a.n + b.n - common.n)),""" + _COMPONENTS + """
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component, d.doc_id) as component_id,
       coalesce(component, d.doc_id) = d.doc_id as kept
from docs d left join sizes using (doc_id) left join comps on node = d.doc_id""",
    "op5_embeddings": """
with recursive good as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
  links as (select a.vec_id as u, b.vec_id as v from good a join good b
            on a.vec_id < b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.95),
  counts as (select u as vec_id, count(*) as n from (select u from links union all select v from links) group by 1),"""
    + _COMPONENTS + """
select t.vec_id, coalesce(n, 0) as n_links, coalesce(component, t.vec_id) as component_id,
       coalesce(component, t.vec_id) = t.vec_id as kept
from embeddings t left join counts using (vec_id) left join comps on node = t.vec_id""",
    "op6_chat": f"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum({_MARKS} + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::bigint as formatted_chars
from rows group by conv_id""",
    "op8_rules": f"""
with docs as (
  select doc_id, source as host, coalesce(text, '') as text,
    [x for x in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] as w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as l
  from documents),
  windows as (select doc_id, i, w[i:i + 2] as s from (
    select doc_id, w, unnest(range(1, len(w) - 1)) as i from docs where len(w) > 2)),
  again as (select doc_id, i from windows qualify count(*) over (partition by doc_id, s) > 1),
  covered as (select doc_id, count(distinct i + k) as n from again, range(0, 3) r(k) group by doc_id),
  counted as (
  select doc_id, host, len(w)::bigint as n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l) as n_lines,
    coalesce(n, 0)::bigint as n_repeat_words from docs left join covered using (doc_id)),
  failed as (
  select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from counted),
  per as (
  select host, count(*) as n, sum((base_failed or 100 * n_symbols > {quality_rules.SYMBOL_PERCENT} * word_chars
    or 100 * n_dup_lines > {quality_rules.LINE_PERCENT} * n_lines)::int) as f
  from failed where host is not null group by host),
  moments as (select sum(f) / sum(n) as p, var_samp(f / n) as var, avg(1 / n) as inverse from per),
  prior as (select p, case when var - p * (1 - p) * inverse > 0 then least(greatest(
    p * (1 - p) / (var - p * (1 - p) * inverse) - 1, {quality_rules.PRIOR_DOCS[0]}), {quality_rules.PRIOR_DOCS[1]})
    else {quality_rules.PRIOR_DOCS[1]} end as w from moments),
  bad as (select host from per, prior where (f + p * w) / (n + w) > {quality_rules.HOST_RATE})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and (host is null or host not in (select host from bad)) as kept
from failed""",
    "op11_fill_middle": r"""
with docs as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
    sha256('42:' || coalesce(doc_id::varchar, '')) as d from documents),
  drawn as (select *, len(units) as n, ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2,
    ('0x' || d[17:24])::bigint as h3, ('0x' || d[25:32])::bigint as h4 from docs),
  formed as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
      then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from drawn),
  cut as (select *, array_to_string(units[1:a], '') as p, array_to_string(units[a + 1:b], '') as m,
    array_to_string(units[b + 1:], '') as s from formed)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
         else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from cut""",
    "op12_spelling": f"""
with recursive bits as (
  select list(list_reduce(range(0, 8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)
              order by i) as t from range(0, 256) r(i)),
  runs as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{LEAST_CHARS},}}')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
  distinct_runs as (select doc_id, run, count(*) as times, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x
                    from runs group by doc_id, run),
  hashed as (select run, times, xor(4294967295, list_reduce(
      [('0x' || x[2 * i - 1:2 * i])::bigint for i in range(1, len(x) // 2 + 1)],
      lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)]), 4294967295)) as h from distinct_runs, bits),
  said as (select case when h % {ONE_IN} = 0 then run[1:h % len(run)] || run[h % len(run) + 2:] else run end as word, times
           from hashed),
  words as (select word, sum(times)::bigint as n from said where len(word) >= {LEAST_CHARS} group by word
            having sum(times) >= {LEAST_COUNT}),
  cut as (select word, n, p, word[1:p - 1] || word[p + 1:] as rest from (
          select word, n, unnest(range(1, len(word) + 1)) as p from words)),
  near as (select a.word, a.n, b.word as other, b.n as other_n from cut a join cut b on a.p = b.p and a.rest = b.rest
             and a.word <> b.word
           union select a.word, a.n, b.word, b.n from cut a join words b on a.rest = b.word
           union select b.word, b.n, a.word, a.n from cut a join words b on a.rest = b.word),
  best as (select word, n, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n
           from near group by word, n),
  forms as (select word, other as form, other_n as form_n from best where other_n >= {spelling.RATIO} * n),
  walk as (select word, form as root, 1 as step from forms
           union all select w.word, f.form, step + 1 from walk w join forms f on f.word = w.root),
  ends as (select word, arg_max(root, step) as root from walk group by word)
select w.word, form, coalesce(root, w.word) as root, w.n, coalesce(n_near, 0) as n_near, form_n
from words w left join best using (word) left join forms using (word) left join ends using (word)""",
    "op13_urls": rf"""
with split as (
  select page_id, case when contains(url, '://') then url[position('://' in url) + 3:] else '' end as rest from pages),
  rows as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split),
  fits as (select u.host, u.path, arg_max(r.text, (len(r.text), len(r.host))) as rule,
    arg_max(r.verdict, (len(r.text), len(r.host))) as verdict
    from (select distinct host, path from rows) u join (values {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}', '{r.text}')" for r in RULES)})
      r(verdict, host, path, text) on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path)
    group by all),
  ruled as (select page_id, host, path, rule, verdict, (verdict = 'block')::int as bad
            from rows left join fits using (host, path)),
  per_host as (select host, count(bad) as n, coalesce(sum(bad), 0) as bad,
    regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.$', '') as name from ruled where host <> '' group by host),
  labelled as (select *, string_split(name, '.') as l, regexp_matches(name, '^[0-9]+(\.[0-9]+){{3}}$|^\[') as own
               from per_host),
  suffixed as (select *, case when own then name when array_to_string(l[-2:], '.') in {url_filter.SUFFIXES}
    then array_to_string(l[-2:], '.') else l[-1] end as suffix from labelled),
  placed as (select host, n, bad, suffix, case when suffix = name then name when suffix in {url_filter.SUFFIXES}
    then array_to_string(l[-3:], '.') else array_to_string(l[-2:], '.') end as domain from suffixed),
  domains as (select suffix, domain, sum(n) as n, sum(bad) as bad from placed group by all),
  suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by all),
  levels as (select 0 as level, domain as parent, n, bad from placed where n > 0
             union all select 1, suffix, n, bad from domains where n > 0
             union all select 2, '', n, bad from suffixes where n > 0),
  parents as (select level, count(*) as k, sum(n)::double as total, sum(bad) / sum(n) as rate,
    sum(n * n)::double as squares, sum(n * (bad / n) * (bad / n)) as raw from levels group by level, parent),
  moments as (select level, sum(raw - total * rate * rate - rate * (1 - rate) * (k - 1)) as over,
    sum(rate * (1 - rate) * (total - squares / total - (k - 1))) as room from parents group by level),
  weights as (select level, coalesce(w, {url_filter.PRIOR_PAGES[1]}) as w from range(0, 3) r(level) left join (
    select level, case when room <= 0 or over <= 0 then {url_filter.PRIOR_PAGES[1]}
      else least(greatest(room / over - 1, {url_filter.PRIOR_PAGES[0]}), {url_filter.PRIOR_PAGES[1]}) end as w
    from moments) using (level)),
  centre as (select (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) as p, coalesce(sum(n), 0) + 1 as known
             from suffixes),
  s as (select suffix, (bad + p * least(w, known)) / (n + least(w, known)) as r, n + least(w, known) as known
        from suffixes, centre, weights where level = 2),
  d as (select domain, (bad + r * least(w, known)) / (n + least(w, known)) as r, n + least(w, known) as known
        from domains join s using (suffix), weights where level = 1),
  h as (select host, (bad + r * least(w, known)) / (n + least(w, known)) as r, n + least(w, known) as known
        from placed join d using (domain), weights where level = 0),
  blocked as (select host from h where r - {url_filter.Z} * sqrt(r * (1 - r) / (known + 1)) > {url_filter.BAD_SHARE})
select page_id, host, path, rule, coalesce(verdict, case when host in (select host from blocked) then 'block' else 'allow'
  end) as verdict
from ruled""",
}

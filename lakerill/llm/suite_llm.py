"""The queries of the training-data operators, and their SQL equivalents where SQL has one."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, divergence, iblt, licenses, merkle, mixing, packing, pii, quality, simhash, substrings, toxicity, urls
from .text import table


#: Rules of the URL query: hosts and paths. Fixed values.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, path("byte_bpe_50k.json"), added=True)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return iblt.fingerprints(table(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    families = F.array_join(F.array_sort(F.array_distinct(F.col("licenses.family"))), ",").alias("licenses")
    return licenses.scan(docs).select("doc_id", families, F.size("licenses").cast("bigint").alias("n_license_paragraphs"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mixing.schedule(docs)
    taken = (F.col("size") * F.size("positions")).cast("bigint").alias("taken")
    # when the curriculum takes a document: once, twice or never
    places = [F.round(F.get("positions", F.lit(i)), 6).alias(f"{name}_position") for i, name in enumerate(("first", "second"))]
    return mixed.select("doc_id", "size", "source_size", "target", taken, *places)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    book = quality.ledger(table(spark, folder, "documents").select("doc_id", "text"))
    measured = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (~quality.passes("base")).alias("base_failed")
    return book.select("doc_id", *measured, failed, quality.passes("v1").alias("kept"), "failures")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.fit(docs, table(spark, folder, "labels")).score(docs)
    held_out = (toxicity.fold("doc_id") == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    extra = F.array(*(F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))))
    added = spark.range(1).select(F.explode(extra).alias("e")).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("e.turn").cast("bigint").alias("turn"), "e.role",
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.read_back(chat.format_conversations(rows)).drop("n_invalid")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digest(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audit(table(spark, folder, "documents"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_simhash": op2_simhash,
    "op3_fingerprints": op3_fingerprints,
    "op4_license_scan": op4_license_scan,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_chat_format": op9_chat_format,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_divergence": op12_source_divergence,
    "op13_pii": op13_pii,
}

ORACLE = {
    "op5_mixing": r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        md5(coalesce(doc_id::varchar, '')) as h
    from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by 1),
ranked as (
    select *, row_number() over (order by source collate "C" nulls last) - 1 as r from sources),
weighed as (
    select *, case r % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w,
        2.0::double * source_size as cap from ranked),
levels as (
    -- the sources that stop first have the smallest ratio of limit and weight
    select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over before, 0))
            / (sum(w) over () - coalesce(sum(w) over before, 0)) as level
    from weighed window before as (order by cap / w, r rows between unbounded preceding and 1 preceding)),
water as (select level from levels where level * w <= cap order by cap / w, r limit 1),
targets as (select source, source_size, r, least(w * (select level from water), cap) as target from weighed),
stream as (
    select d.doc_id, d.size, t.source_size, t.target, t.r,
        coalesce(sum(d.size) over (partition by d.source order by d.h, d.doc_id
            rows between unbounded preceding and 1 preceding), 0) as start
    from sized d join targets t on d.source is not distinct from t.source),
-- each schedule's pieces: the share used before, the weight and its slope there, and when the piece begins
pieces(k, before, height, slope, begins) as (values
    (0, 0.0::double, 1.5::double, -1.0::double, 0.0::double), (0, 0.625, 1.0, -1.0, 0.5),
    (1, 0.0, 1.0, 0.0, 0.0), (1, 0.5, 1.0, 0.0, 0.5), (2, 0.0, 0.5, 1.0, 0.0), (2, 0.375, 1.0, 1.0, 0.5)),
middles as (
    select *, unnest([0, 1]) as time from (select *, row_number() over () as i from stream)),
used as (
    select *, start + time * source_size + size / 2.0::double as middle,
        case when target > 0 then (start + time * source_size + size / 2.0::double) / target else 0.0::double end as u from middles),
-- the weight's integral, inverted: height * x + slope / 2 * x * x is the share used since the piece began
placed as (
    select x.*, case when middle <= target then round(least(begins + 0.5, begins + case when u > before
        then 2 * (u - before) / (height + sqrt(greatest(0.0, height * height + 2 * slope * (u - before)))) else 0 end), 6) end as position
    from used x join pieces p on p.k = x.r % 3 and p.before <= x.u
    qualify row_number() over (partition by i, time order by before desc) = 1)
select doc_id, size, source_size::bigint as source_size, target::double as target,
    (size * count(position))::bigint as taken, min(position) filter (time = 0) as first_position, min(position) filter (time = 1) as second_position
from placed group by i, doc_id, size, source_size, target""",
    "op6_quality_rules": r"""
with split as (
    select doc_id, coalesce(text, '') as text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w,
        [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
    from documents),
windows as (
    select doc_id, i, count(*) over (partition by doc_id, w[i:i + 4]) as n
    from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from split)),
covered as (
    select distinct doc_id, i + unnest(range(0, 5)) as i from windows where n > 1),
repeated as (select doc_id, count(*) as n from covered group by 1),
measured as (
    select s.doc_id, len(w)::bigint as n_words,
        coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
        len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(r.n, 0)::bigint as n_repeat_words,
        len(regexp_extract_all(text, '[A-Z]')) as n_upper, len(regexp_extract_all(text, '[A-Za-z]')) as n_letters
    from split s left join repeated r on s.doc_id = r.doc_id),
judged as (
    select *, (n_words < 10)::bigint + 2 * (100 * n_repeat_words > 20 * n_words)::bigint
        + 4 * (5 * n_symbols > n_words)::bigint + 8 * (10 * n_dup_lines > 3 * n_lines)::bigint
        + 16 * (2 * n_upper > n_letters)::bigint + 32 * (word_chars > 20 * n_words)::bigint
        + 64 * (word_chars < 2 * n_words)::bigint as failures
    from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 as base_failed,
    (failures & 23) = 0 as kept, failures
from judged""",
    "op9_chat_format": r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marks as (select unnest(['<<SYS>>', '<</SYS>>', '[INST]', '[/INST]', '<s>', '</s>', '[ROLE]', '[TEXT]', '[/ROLE]']) as m),
escaped as (
    select *, length(text) + length(text) - length(replace(text, chr(92), ''))
        + (select sum((length(text) - length(replace(text, m, ''))) // length(m)) from marks) as chars
    from rows),
written as (
    select *, chars + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 7
        else 19 + length(role) end as formatted
    from escaped)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(formatted)::bigint as formatted_chars
from written group by conv_id""",
    "op10_substring_dedup": r"""
with split as (
    select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
starts as (
    select doc_id, w, unnest(range(1, len(w) - 48)) as i from split),
windows as (
    select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from starts),
marked as (
    select doc_id, i, doc_id > min(doc_id) over (partition by h) as late from windows),
words as (
    select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from split),
covered as (
    select s.doc_id, s.i, s.word,
        coalesce(max(case when m.late then s.i end) over (
            partition by s.doc_id order by s.i rows between 49 preceding and current row) is not null, false) as gone
    from words s left join marked m on s.doc_id = m.doc_id and s.i = m.i),
kept as (
    select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept
    from covered group by 1)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed,
    sha256(coalesce(k.kept, '')) as kept_sha256
from split d left join kept k on d.doc_id = k.doc_id""",
    "op11_merkle_manifest": r"""
with recursive fields as (
    select row_number() over () as i, doc_id, source, text,
        coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
        -- crc32, bit by bit: each byte is followed by seven steps without one
        xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''),
            lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
            lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) % 5 = 0 as chosen
    from documents),
leaves as (
    select i, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        case when chosen then sha256(head || coalesce(strlen(text) || ':' || translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) end as changed
    from fields),
placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as r,
        count(*) over (partition by source) as n from leaves),
nodes as (
    select 0 as level, source, r, n, leaf as h from placed
    union all
    select level + 1, source, r // 16, (n + 15) // 16, sha256(string_agg(h, '' order by r))
    from nodes where n > 1 group by level, source, r // 16, n),
runs as (select level, source, r // 16 as run, string_agg(h, '' order by r) as joined from nodes where n > 1 group by 1, 2, 3),
subroots as (
    select source, h as subroot, row_number() over (order by source nulls first) - 1 as r, count(*) over () as n
    from nodes where n = 1),
upper_nodes as (
    select 0 as level, r, n, subroot as h from subroots
    union all
    select level + 1, r // 16, (n + 15) // 16, sha256(string_agg(h, '' order by r))
    from upper_nodes where n > 1 group by level, r // 16, n),
upper_runs as (select level, r // 16 as run, string_agg(h, '' order by r) as joined from upper_nodes where n > 1 group by 1, 2),
folded as (
    select i, source, 0 as level, r, coalesce(changed, leaf) as h, '' as siblings from placed
    union all
    select f.i, f.source, f.level + 1, f.r // 16,
        sha256(left(u.joined, 64 * (f.r % 16)) || f.h || substr(u.joined, 64 * (f.r % 16) + 65)),
        f.siblings || left(u.joined, 64 * (f.r % 16)) || substr(u.joined, 64 * (f.r % 16) + 65)
    from folded f join runs u on u.level = f.level and u.source is not distinct from f.source and u.run = f.r // 16),
below as (select * from folded qualify row_number() over (partition by i order by level desc) = 1),
above as (
    select b.i, 0 as level, s.r, b.h, b.siblings from below b join subroots s on s.source is not distinct from b.source
    union all
    select f.i, f.level + 1, f.r // 16,
        sha256(left(u.joined, 64 * (f.r % 16)) || f.h || substr(u.joined, 64 * (f.r % 16) + 65)),
        f.siblings || left(u.joined, 64 * (f.r % 16)) || substr(u.joined, 64 * (f.r % 16) + 65)
    from above f join upper_runs u on u.level = f.level and u.run = f.r // 16),
done as (select * from above qualify row_number() over (partition by i order by level desc) = 1),
top as (select h as root from upper_nodes where n = 1)
select p.doc_id, p.leaf, s.subroot, t.root, sha256(d.siblings) as proof_sha256, d.h as folded_root, d.h = t.root as verified
from placed p join subroots s on s.source is not distinct from p.source join done d on d.i = p.i cross join top t""",
    "op12_source_divergence": r"""
with docs as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as t
    from documents),
words as (select d, lang, source, unnest(t) as term from docs),
kept as (select lang, term, count(*)::hugeint as total from words group by 1, 2 having count(distinct d) >= 30),
langs as (select lang, count(*)::hugeint as v, sum(total)::hugeint as n from kept group by 1),
counts as (select lang, source, term, count(*)::hugeint as n from words join kept using (lang, term) group by 1, 2, 3),
groups as (
    select g.lang, g.source, coalesce(l.v, 0) as v, coalesce(l.n, 0) as lang_n,
        coalesce((select sum(n) from counts c where c.lang = g.lang and c.source = g.source), 0)::hugeint as n
    from (select distinct lang, source from docs) g left join langs l on l.lang = g.lang),
shares as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as c,
        1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (g.n + 5 * g.v) as p,
        1 + 1000000000::hugeint * (k.total + 5) // (g.lang_n + 5 * g.v) as q
    from groups g join kept k on k.lang = g.lang
    left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join (select x.lang, x.source as a, y.source as b, sum(abs(x.p - y.p)) as value from shares x
        join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by 1, 2, 3) s
        on s.lang = a.lang and s.a = a.source and s.b = b.source),
items as (
    select * from pairs
    union all select lang, source, 'term', term, (p - q)::bigint from shares where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from items)
select * from ranked where part = 'pair' or rank <= 50""",
}

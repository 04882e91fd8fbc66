"""The registered queries of the operators for training data, and their SQL.

Each query reads whole tables with production parameters and derives its columns from
what its operator returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import bpe, chat, collocations, conversation_repair, katz, line_dedup, minhash, mixing, quality_rules, site_quality, token_stream, topk, warc
from starfold.session import shared_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = line_dedup.dropped_lines(table(spark, sf_dir, "documents"))
    return gone.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "kept_doc_id", F.col("kept_line_no").cast("long").alias("kept_line_no"), "edits")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return site_quality.classify(docs, site_quality.train(docs, table(spark, sf_dir, "labels")))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    log = chat.events_of_turns(turns.unionByName(added))
    return chat.digests(chat.read_back(chat.render(chat.messages(log))))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality_rules.verdict(F.col("text"), model).alias("v")).select("doc_id", "v.*")


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return katz.score(docs.select("doc_id", "text", held.alias("held")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def encoded(docs: DataFrame) -> DataFrame:
    """``docs`` with ``ids`` in place of ``text``."""
    ids = bpe.encode(F.coalesce("text", F.lit("")), RANKS, public_tokenizers.PATTERN)
    return docs.withColumn("text", ids).withColumnRenamed("text", "ids")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    both = ids.select("doc_id", "ids", bpe.decode(F.col("ids"), RANKS, public_tokenizers.PATTERN).alias("decoded"))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.rated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), of_kept=True)
    posteriors = [F.round(F.col(f" {d}"), 9).alias(f"p_{d}") for d in mixing.DOMAINS]
    return rows.select(F.col(" row.doc_id").alias("doc_id"), F.col(" tokens").alias("n_tokens"), *posteriors, F.round(" rate", 6).alias("rate"), F.col(" copies").alias("copies"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return topk.search(docs, docs.where("doc_id % 100 = 0"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))
    return conversation_repair.digests(*found).drop("rows")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_stream.write(table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return token_stream.digests(token_stream.read(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup, "op2_quality_classifier": op2_quality_classifier, "op3_chat_formatting": op3_chat_formatting, "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules, "op6_katz": op6_katz, "op7_minhash": op7_minhash, "op8_bpe": op8_bpe, "op9_mixing": op9_mixing, "op10_topk": op10_topk,
    "op11_conversation_repair": op11_conversation_repair, "op12_collocations": op12_collocations, "op13_token_stream": op13_token_stream,
}

_ESCAPE = r"""regexp_replace({0}, '([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')"""

# One row's edits as structs of cost, letters and repaired lines, per state of the order.
_EDIT = "{{'c': {0}.c + {1}, 'a': {0}.a || '{2}', 't': {0}.t{3}}}"
_INSERTED = {
    "x2": "list_sort([s2, {}, {}, {}])[1]".format(*(_EDIT.format(s, 2, "I", " || chr(10) || 'user:'") for s in ("s0", "s1", "s3"))),
    "x3": "list_sort([s3, {}])[1]".format(_EDIT.format("x2", 2, "I", " || chr(10) || 'assistant:'")),
}


def _edits(state: str, sources: str, initial: str, name: str) -> str:
    """All ways of taking a row that end in ``state``."""
    ways = [_EDIT.format(state, 3, "D", "")]
    for x in sources.split():
        free = f"(case when fault in ('blank', 'duplicate') {{}} then 1000000 else 0 end) + (fault = 'truncated')::int"
        ways.append(_EDIT.format(x, free.format(f"or role[1] <> '{initial}'"), "K", " || chr(10) || role || ':' || text"))
        if name:
            ways.append(_EDIT.format(x, "2 + " + free.format(""), "R", f" || chr(10) || '{name}:' || text"))
    return f"list_sort([{', '.join(ways)}])[1]"


SQL: dict[str, str] = {
    "op12_collocations": r"""
with lowered as (
    select coalesce(lang, 'und') as lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from lowered),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
places as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from worded),
grams as (
    select lang, unnest([ws[i:i], ws[i:i + 1], ws[i:i + 2]]) as gram, unnest([1, 2, 3]) as size from places),
counts as (select lang, gram, size, count(*) as f from grams where len(gram) = size group by all),
frequent as (select * from counts where f >= 10),
cuts as (
    select c.lang, c.gram, c.size, c.f as a, k, x.f as l, y.f as r, (1000000::hugeint * c.f * c.f) // (x.f::hugeint * y.f) as score
    from (select *, unnest(range(1, size)) as k from frequent) c
    join frequent x on x.lang = c.lang and x.gram = c.gram[1:k]
    join frequent y on y.lang = c.lang and y.gram = c.gram[k + 1:]),
lowest as (select * from cuts qualify row_number() over (partition by lang, gram order by score, k) = 1),
longer as (
    select lang, gram[1:2] as gram, f from frequent where size = 3 union all select lang, gram[2:3], f from frequent where size = 3),
highest as (select lang, gram, max(f) as f from longer group by all),
standing as (
    select lowest.*, array_to_string(gram, ' ') as phrase from lowest left join highest using (lang, gram)
    where highest.f is null or 100 * highest.f < 50 * a),
totals as (select lang, sum(len(ws))::bigint as n from worded group by lang)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from standing join totals using (lang) qualify rank <= 2000""",
    "op11_conversation_repair": f"""
with recursive bits as (
    select i, i::bigint as v, 0 as k from range(256) t(i)
    union all select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8),
crcs as (select list(v order by i) as crc from bits where k = 8),
named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
summed as (
    select named.*, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind
    from named, crcs),
copied as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case when kind <= 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
        unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy
    from summed),
placed as (
    select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as trimmed,
        row_number() over (partition by conv_id order by turn nulls first, role, sha256(length(role) || ':' || role || text), copy) as i
    from copied),
rows as (
    select conv_id, turn, role, text, i,
        case when trimmed = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
            when right(trimmed, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
        left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) not in ('su', 'ua', 'au') as illegal
    from placed),
walk as (
    select distinct conv_id, 0::bigint as i, {{'c': 0, 'a': '', 't': ''}} as s0, {{'c': 1000000, 'a': '', 't': ''}} as s1,
        {{'c': 1000000, 'a': '', 't': ''}} as s2, {{'c': 1000000, 'a': '', 't': ''}} as s3 from conversations
    union all
    select conv_id, i, {_edits('s0', '', '', '')}, {_edits('s1', 's0', 's', '')}, {_edits('x2', 's0 s1 x3', 'u', 'user')}, {_edits('x3', 'x2', 'a', 'assistant')}
    from (
        select *, {_INSERTED['x3']} as x3
        from (
            select walk.conv_id, walk.i + 1 as i, s0, s1, s2, s3, {_INSERTED['x2']} as x2, role, text, fault
            from walk join rows on rows.conv_id is not distinct from walk.conv_id and rows.i = walk.i + 1))),
ends as (
    select conv_id, list_sort([s0, {_INSERTED['x3']}])[1] as best
    from (select *, {_INSERTED['x2']} as x2 from walk)
    qualify row_number() over (partition by conv_id order by i desc) = 1),
counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated, count(*) filter (illegal) as illegal
    from rows group by conv_id)
select ends.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
    coalesce(illegal, 0) as illegal, best.c::bigint as cost, best.a as audit, sha256(substr(best.t, 2)) as repaired_sha256
from ends left join counts on counts.conv_id is not distinct from ends.conv_id""",
    "op1_line_dedup": """
with split as (select doc_id, string_split(text, chr(10)) as lines from documents where doc_id is not null),
numbered as (select doc_id, lines, unnest(range(1, len(lines) + 1)) as i from split),
line as (select doc_id, i - 1 as line_no, lines[i] as line from numbered where regexp_matches(lines[i], '[^\\x20\\x09-\\x0D]')),
firsts as (select line, length(line) as n, min(struct_pack(doc_id := doc_id, line_no := line_no)) as place from line group by line),
long as (select * from firsts where n >= 20),
pairs as (
    select a.line as a, b.line as b, a.place as pa, b.place as pb, a.n as n, b.n - a.n as longer from long a join long b
    on b.n in (a.n, a.n + 1) and a.line <> b.line and left(a.line, 8) = left(b.line, 8)
    union
    select a.line, b.line, a.place, b.place, a.n, b.n - a.n from long a join long b
    on b.n in (a.n, a.n + 1) and a.line <> b.line and right(a.line, 8) = right(b.line, 8)),
close as (
    select * from pairs
    where len(list_filter(range(1, n + 2), lambda i: left(a, i - 1) = left(b, i - 1) and substr(a, i + 1 - longer) = substr(b, i + 1))) > 0),
near as (select line, min(kept) as kept from (select b as line, pa as kept from close where pa < pb union all select a, pb from close where pb < pa) group by line)
select doc_id, line_no, coalesce(near.kept, firsts.place).doc_id as kept_doc_id, coalesce(near.kept, firsts.place).line_no as kept_line_no,
    case when near.kept is null then 0 else 1 end as edits
from line join firsts using (line) left join near using (line)
where near.kept is not null or struct_pack(doc_id := doc_id, line_no := line_no) <> firsts.place""",
    "op3_chat_formatting": f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(20 + length({_ESCAPE.format('role')}) + length({_ESCAPE.format('text')})) as bigint) as formatted_chars
from turns group by conv_id""",
    "op4_warc": """
with raw as (select page_id, coalesce(html, '') as html from pages),
sized as (select page_id, strlen(html) as payload_bytes, sha256(html) as payload_digest from raw),
found as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from sized)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
    case when page_id <> first_id then first_id end as refers_to
from found""",
}

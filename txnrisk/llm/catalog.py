"""One query per operator over its whole table, and the SQL counterparts where there are any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import (
    conversations,
    decontaminate,
    langid,
    lines,
    mixing,
    neardup,
    pitmanyor,
    quality,
    spelling,
    suffixes,
    tokenids,
    tokens,
    topk,
)
from txnrisk.llm.common import crc_fold, stage, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, mixing.cyclic_weights(docs), budget=1.5, most=2.0)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


OP1_SQL = r"""
with recursive sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select source, source_size, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w,
    source_size * 2.0::double as cap from sources
), sorted as (
  select *, sum(source_size) over () * 1.5::double as budget,
    coalesce(sum(cap) over (order by cap / w, source rows between unbounded preceding and 1 preceding), 0) as used,
    sum(w) over (order by cap / w, source rows between current row and unbounded following) as open
  from weighed
), level as (
  select arg_min((budget - used) / open, cap / w) as level from sorted where (budget - used) / open <= cap / w
), targets as (
  select source, source_size, least(w * level, cap) as target from weighed, level
), rates as (
  select *, case when source_size > 0 then least(target / source_size, 2.0::double) else 0 end as rate from targets
)
select s.doc_id, s.size, r.source_size, r.target,
  (s.size * (floor(r.rate) + case when
    cast('0x' || substr(md5('17:' || coalesce(cast(s.doc_id as varchar), 'null')), 1, 13) as bigint) / 4503599627370496.0::double
    < r.rate - floor(r.rate) then 1 else 0 end))::bigint as taken
from sized s join rates r on s.source is not distinct from r.source
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(crc_fold("doc_id", 5) != 0)
    space = quality.learn(docs, labels)
    scored = quality.score(docs, space)
    held_out = (crc_fold("doc_id", 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_pitmanyor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_fold("doc_id", 7) == 2
    scored = pitmanyor.score_documents(table(spark, sf_dir, "documents"), ~held_out, sweeps=pitmanyor.QUERY_SWEEPS)
    return scored.withColumn("held_out", held_out)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = lines.drop_lines(docs, host="source", ratio=0.1, min_pages=3, counts=True)
    return kept.select("doc_id", "source", "n_lines", "n_dropped", "text")


OP5_SQL = r"""
with split as (
  select doc_id, source, text, row_number() over () as row, string_split(text, chr(10)) as lines from documents
), each as (
  select distinct row, source, trim(line, ' ' || chr(9) || chr(13)) as line from (select row, source, unnest(lines) as line from split)
), hosts as (
  select source, count(*) as host_pages from documents group by source
), bad as (
  select e.source, e.line from each e join hosts h on e.source is not distinct from h.source
  where e.line <> '' group by e.source, e.line, h.host_pages having count(*) >= 3 and count(*) > 0.1::double * h.host_pages
), lists as (
  select source, list(line) as bad from bad group by source
), kept as (
  select s.doc_id, s.source, s.text, s.lines, case when l.bad is null then s.lines else
    list_filter(s.lines, lambda x: not list_contains(l.bad, trim(x, ' ' || chr(9) || chr(13)))) end as kept
  from split s left join lists l on s.source is not distinct from l.source
)
select doc_id, source, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(lines) - len(kept), 0)::bigint as n_dropped,
  case when len(lines) = len(kept) or text is null then text else coalesce(array_to_string(kept, chr(10)), '') end as text
from kept
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), size=5, containment=0.8)


OP6_SQL = r"""
with item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from benchmark
), doc_words as (
  select doc_id, row_number() over () as row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), items as (
  select distinct item_id, least(len(w), 5) as size, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') as s
  from (select item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from item_words where len(w) > 0)
), sizes as (
  select distinct size from items
), counts as (
  select item_id, count(*) as n_item from items group by item_id
), shingles as (
  select distinct doc_id, row, size, array_to_string(w[i : i + size - 1], ' ') as s
  from (select doc_id, row, w, size, unnest(range(1, len(w) - size + 2)) as i from doc_words, sizes where len(w) >= size)
)
select d.doc_id, i.item_id, count(*)::bigint as n_shared, c.n_item::bigint as n_item, count(*) / c.n_item::double as containment
from shingles d join items i on d.size = i.size and d.s = i.s join counts c on c.item_id = i.item_id
group by d.doc_id, d.row, i.item_id, c.n_item having count(*) >= 0.8::double * c.n_item - 1e-9
"""


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    profiles = langid.load(langid.learn(docs.filter(crc_fold("doc_id", 3) != 1)))
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold_percent=80)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.load_vocabulary())


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20, scale=64.0)


OP10_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 20
"""


def op11_tokenids(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids of all documents, written to wavelet shards and read back from them; null texts have the end id only.

    Rows without a doc_id come first, repeated ones count each; no documents give no rows.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    folder = tokenids.write_shards(table(spark, sf_dir, "documents"), definition, end=2)
    return tokenids.read_documents(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and their cheapest repair, a row per original conversation.

    Rows without a conv_id form one; see ``conversations.repair`` on nulls, ties and repeats.
    """
    rows = table(spark, sf_dir, "conversations")
    fixed = conversations.repair(conversations.damaged(rows))
    audits = fixed.audits.withColumnRenamed("conv_id", "_audited")
    sums = stage(conversations.digests(fixed.repaired), "conversation-sums").withColumnRenamed("conv_id", "_hashed")
    every = rows.select("conv_id").distinct()
    joined = every.join(audits, F.col("conv_id").eqNullSafe(F.col("_audited")) & F.col("cost").isNotNull(), "left")
    joined = joined.join(sums, F.col("conv_id").eqNullSafe(F.col("_hashed")) & F.col("sha256").isNotNull(), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def crc32_sql(byte_list: str) -> str:
    """The unsigned crc32 of a list of bytes: the byte is taken in, then eight bits are shifted out."""
    steps = f"flatten(list_transform({byte_list}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    turn = "case when e >= 0 then xor(c, e) else xor(c >> 1, 3988292384 * (c & 1)) end"
    return f"xor(list_reduce(list_transform({steps}, lambda e: e::bigint), lambda c, e: {turn}, 4294967295::bigint), 4294967295::bigint)"


def _edit_sql(add: str, letter: str, line: str, best: str) -> str:
    """A way to go, as nine digits of cost, the edits, chr(1) and the lines: one edit put in front of another."""
    lines = f"substr({best}, instr({best}, chr(1)) + 1)"
    if line:
        lines = f"{line} || case when {lines} = '' then '' else chr(10) || {lines} end"
    edits = f"substr({best}, 10, instr({best}, chr(1)) - 10)"
    return f"lpad((substr({best}, 1, 9)::int + {add})::varchar, 9, '0') || '{letter}' || {edits} || chr(1) || {lines}"


def _rows_sql(state: int, follow: dict[str, int]) -> str:
    """The best way from a state if nothing is inserted before the row."""
    ways = [_edit_sql("4", "D", "", f"f.w{state}")]
    for letter, after in follow.items():
        kept = _edit_sql("case when r.fault = 3 then 3 else 0 end", "K", "r.role || ':' || r.text", f"f.w{after}")
        ways.append(f"case when r.fault in (0, 3) and r.role[1] = '{letter}' then {kept} end")
        if letter != "s":
            name = {"u": "user", "a": "assistant"}[letter]
            changed = _edit_sql("case when r.fault = 3 then 6 else 3 end", "R", f"'{name}:' || r.text", f"f.w{after}")
            ways.append(f"case when r.fault in (0, 3) then {changed} end")
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x is not null))"


def _inserted(name: str, best: str) -> str:
    return _edit_sql("3", "I", f"'{name}:'", best)


OP12_SQL = rf"""
with recursive marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc32_sql(
    "list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x))"
  )} % 20 as damage from conversations
), rows as (
  select conv_id, turn, case when damage = 4 then 'user' else role end as role,
    case damage when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(case when damage = 3 then [0, 1] else [0] end) from marked where damage <> 0)
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from rows
), faulty as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 1
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 2
    when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 3 else 0 end as fault,
    lag(role) over (partition by conv_id order by i) as earlier
  from numbered
), counts as (
  select conv_id, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 1) as blank, count(*) filter (where fault = 2) as duplicate, count(*) filter (where fault = 3) as truncated,
    count(*) filter (where i > 1 and substr(earlier, 1, 1) || substr(role, 1, 1) not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id
), ways as (
  select conv_id, n + 1 as i, '000000000' || chr(1) as w0, '000000006II' || chr(1) || 'user:' || chr(10) || 'assistant:' as w1,
    '000000003I' || chr(1) || 'assistant:' as w2, '000000000' || chr(1) as w3 from counts
  union all
  select conv_id, i, least(g0, {_inserted("user", "h2")}) as w0, least(g1, {_inserted("user", "h2")}) as w1, h2 as w2,
    least(g3, {_inserted("user", "g2")}) as w3
  from (
    select *, least(g2, {_inserted("assistant", "g3")}) as h2 from (
      select r.conv_id, r.i, {_rows_sql(0, {"s": 1, "u": 2})} as g0, {_rows_sql(1, {"u": 2})} as g1,
        {_rows_sql(2, {"a": 3})} as g2, {_rows_sql(3, {"u": 2})} as g3
      from ways f join faulty r on f.conv_id is not distinct from r.conv_id and r.i = f.i - 1
    )
  )
), best as (
  select conv_id, w0 from ways where i = 1
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(substr(w0, 1, 9)::bigint, 0) as cost,
  coalesce(substr(w0, 10, instr(w0, chr(1)) - 10), '') as audit, sha256(coalesce(substr(w0, instr(w0, chr(1)) + 1), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on o.conv_id is not distinct from c.conv_id left join best b on o.conv_id is not distinct from b.conv_id
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the frequent words of all documents, some of whose runs of letters are misspelt first.

    Null texts have no words, rows without a doc_id count as one of empty id, repeated rows count each.
    """
    docs = table(spark, sf_dir, "documents")
    return spelling.variants(stage(spelling.vocabulary(spelling.misspelt(docs)), "spelling-words"))


OP13_SQL = rf"""
with recursive runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
  from documents
), distinct_runs as (
  select doc_id, run, count(*) as n from runs group by doc_id, run
), hashed as (
  select run, n, {crc32_sql(
    "flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), "
    "lambda x: case when unicode(x) < 128 then [unicode(x)] else [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)] end))"
  )} as h from distinct_runs
), words as (
  select case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
  from hashed
), vocabulary as (
  select word, sum(n)::bigint as n from words where length(word) >= 6 group by word having sum(n) >= 5
), cut as (
  select word, n, i, left(word, i) || '*' || substr(word, i + 2) as hole, left(word, i) || substr(word, i + 2) as less
  from (select word, n, unnest(range(length(word))) as i from vocabulary)
), pairs as (
  select a.word, b.word as near, b.n as near_n from cut a join cut b on a.hole = b.hole and a.word <> b.word
  union select a.word, v.word, v.n from cut a join vocabulary v on a.less = v.word
  union select v.word, a.word, a.n from cut a join vocabulary v on a.less = v.word
), ranked as (
  select word, near, near_n, row_number() over (partition by word order by near_n desc, near) as rank, count(*) over (partition by word) as n_near
  from pairs
), formed as (
  select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when near_n >= 5 * v.n then near end as form,
    case when near_n >= 5 * v.n then near_n end as form_n
  from vocabulary v left join ranked r on r.word = v.word and r.rank = 1
), chains as (
  select word, form, 1 as step, coalesce(form, word) as root from formed
  union all
  select c.word, c.form, c.step + 1, f.form from chains c join formed f on f.word = c.root where c.form is not null and f.form is not null
), roots as (
  select word, arg_max(root, step) as root from chains group by word
)
select f.word, form, root, n, n_near, form_n from formed f join roots r on r.word = f.word
"""

QUERIES = {
    f.__name__: f
    for f in (op1_mixing, op2_quality, op3_suffixes, op4_pitmanyor, op5_lines, op6_decontaminate, op7_language, op8_neardup, op9_tokens, op10_topk,
              op11_tokenids, op12_conversations, op13_spelling)
}
ORACLE = {"op1_mixing": OP1_SQL, "op5_lines": OP5_SQL, "op6_decontaminate": OP6_SQL, "op10_topk": OP10_SQL,
          "op12_conversations": OP12_SQL, "op13_spelling": OP13_SQL}

"""Conversations, text shaping, selection, sets and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Inputs, query, view
from patchloom.functions import chat as C
from patchloom.functions import text as T
from patchloom.operators import chats as H
from patchloom.operators import packing as P
from patchloom.operators import reports as R
from patchloom.operators import splits as X

TURN = "concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10))"

view(
    "v_chat",
    f"SELECT conv_id, string_agg({TURN}, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id",
)


@query("SELECT conv_id, text FROM v_chat")
def render_chat(t: Inputs):
    return H.render_chat(t.conversations)


@query(
    f"""
SELECT conv_id, turn, CAST(skip + 22 AS BIGINT) AS start, CAST(skip + 22 + length(text) AS BIGINT) AS "end"
FROM (SELECT *, coalesce(sum(length({TURN})) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS skip
  FROM conversations) WHERE role = 'assistant'"""
)
def completion_spans(t: Inputs):
    return H.completion_spans(t.conversations)


@query(
    f"""SELECT conv_id, CAST(sum(length({TURN})) AS BIGINT) AS chars,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS trained_chars,
  round(1 - sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) / sum(length({TURN})), 6) AS masked_share
FROM conversations GROUP BY conv_id"""
)
def masked_share(t: Inputs):
    return H.masked_share(t.conversations).withColumn("masked_share", F.round("masked_share", 6))


@query("SELECT conv_id, text FROM v_chat")
def to_messages_sharegpt(t: Inputs):
    # turns written in the other layout, then converted and rendered: a round trip
    names = F.create_map(*[F.lit(x) for k, v in C.ROLE_NAMES.items() for x in (v, k)])
    other = F.struct(
        F.coalesce(F.try_element_at(names, F.col("role")), F.col("role")).alias("from"),
        F.col("text").alias("value"),
    )
    rows = H.collect_turns(t.conversations, other, "conversations")
    return C.to_messages(rows, "sharegpt").select("conv_id", C.render_messages(F.col("messages")).alias("text"))


@query(
    """SELECT doc_id, concat('<|im_start|>user', chr(10), 'Write in ', lang,
  CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '' ELSE concat(chr(10), chr(10), source) END, '<|im_end|>', chr(10),
  '<|im_start|>assistant', chr(10), text, '<|im_end|>', chr(10)) AS text FROM documents"""
)
def to_messages_alpaca(t: Inputs):
    rows = t.documents.select(
        "doc_id",
        F.concat(F.lit("Write in "), F.col("lang")).alias("instruction"),
        F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 2, F.col("source")).alias("input"),
        F.col("text").alias("output"),
    )
    return C.to_messages(rows, "alpaca").select("doc_id", C.render_messages(F.col("messages")).alias("text"))


@query(
    """
SELECT conv_id, turn, 'xml' AS style, CASE WHEN role = 'assistant' THEN concat('<action>', text, '</action>') ELSE text END AS text FROM conversations
UNION ALL
SELECT conv_id, turn, 'ticks', CASE WHEN role = 'assistant' THEN concat('```', chr(10), text, chr(10), '```') ELSE text END FROM conversations
UNION ALL
SELECT conv_id, turn, 'tool', CASE WHEN role = 'assistant' THEN CAST(to_json({'tool': 'run', 'arguments': {'command': text}}) AS VARCHAR) ELSE text END FROM conversations"""
)
def render_actions(t: Inputs):
    outs = [
        C.render_actions(t.conversations, s).select("conv_id", "turn", F.lit(s).alias("style"), "text")
        for s in C.ACTION_STYLES
    ]
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


@query(
    """SELECT conv_id, turn, role, n > 4 AS truncated FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
  count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE rn <= 4"""
)
def limit_steps(t: Inputs):
    return H.limit_steps(t.conversations, 4).select("conv_id", "turn", "role", "truncated")


@query("SELECT c.* FROM conversations c SEMI JOIN (SELECT conv_id FROM fx_reports WHERE resolved) r ON c.conv_id = r.conv_id")
def select_resolved(t: Inputs):
    return H.select_resolved(t.conversations, t.fx_reports)


@query("SELECT c.* FROM conversations c ANTI JOIN (SELECT conv_id FROM fx_reports WHERE resolved) r ON c.conv_id = r.conv_id")
def select_failed(t: Inputs):
    return H.select_failed(t.conversations, t.fx_reports)


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE role = 'assistant')")
def answered(t: Inputs):
    return H.answered(t.conversations).select("conv_id", "turn", "role")


LABELLED = "SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
RULES_SQL = {
    "empty": "coalesce(trim(text), '') = ''",
    "low_quality": "coalesce(quality = 0, false)",
    "toxic": "coalesce(toxic = 1, false)",
    "too_short": "len(regexp_extract_all(text, '\\S+')) < 50",
    "too_long": "ceil(length(text) / 4.0) > 4000",
}


def labelled(t: Inputs):
    return t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left")


def rules():
    text = F.col("text")
    return {
        "empty": T.is_blank(text),
        "low_quality": F.col("quality") == 0,
        "toxic": F.col("toxic") == 1,
        "too_short": T.word_count(text) < 50,
        "too_long": T.est_tokens(text) > 4000,
    }


view("v_labelled", LABELLED)


@query(f"SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM v_labelled WHERE NOT ({' OR '.join(RULES_SQL.values())})")
def quality_filter(t: Inputs):
    kept = H.quality_filter(labelled(t), rules())
    return kept.select("doc_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")])


def first_removed_sql() -> str:
    case = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in RULES_SQL.items()) + " END"
    parts = [
        f"SELECT '{n}' AS rule, (SELECT count(*) FROM v_labelled) AS rows, "
        f"(SELECT count(*) FROM v_labelled WHERE {c}) AS hits, "
        f"(SELECT count(*) FROM v_labelled WHERE {case} = '{n}') AS removed"
        for n, c in RULES_SQL.items()
    ]
    return " UNION ALL ".join(parts)


@query(first_removed_sql())
def quality_report(t: Inputs):
    return H.quality_report(labelled(t), rules())


@query(
    """SELECT count(*) AS examples, 1::BIGINT AS files, CASE WHEN count(*) < 300 THEN 'small' WHEN count(*) <= 999 THEN 'medium' ELSE 'large' END AS size_class,
  count(*) < 100 AS under_minimum FROM (SELECT DISTINCT conv_id FROM conversations)"""
)
def dataset_profile(t: Inputs):
    # a conversation is one example, wherever its turns lie
    examples = t.conversations.groupBy("conv_id").agg(F.min("_metadata.file_path").alias("file"))
    return H.dataset_profile(examples, F.col("file"))


@query(
    "SELECT CAST(sum(CASE WHEN resolved THEN 1 ELSE 0 END) AS BIGINT) AS resolved, count(*) AS total, "
    "concat(sum(CASE WHEN resolved THEN 1 ELSE 0 END), '/', count(*)) AS rate FROM fx_reports"
)
def resolve_rate(t: Inputs):
    return R.resolve_rate(t.fx_reports)


CUT = "concat(left(text, 2000), chr(10), '... [truncated] ...', chr(10), right(text, 2000))"


@query(f"SELECT doc_id, CASE WHEN length(text) > 4000 THEN {CUT} ELSE text END AS text FROM documents")
def truncate_middle(t: Inputs):
    return t.documents.select("doc_id", T.truncate_middle(F.col("text")).alias("text"))


@query(f"SELECT doc_id, lang, CASE WHEN length(text) > 4000 THEN {CUT} ELSE text END AS trace FROM documents")
def cut_trace(t: Inputs):
    outputs = F.struct(F.col("text").alias("Agent Trace"), F.col("lang").alias("Language"))
    records = t.documents.select("doc_id", F.struct(F.col("source"), outputs.alias("Generated Outputs")).alias("info"))
    cut = records.select("doc_id", T.cut_trace(F.col("info"))["Generated Outputs"].alias("outputs"))
    return cut.select("doc_id", F.col("outputs.Language").alias("lang"), F.col("outputs")["Agent Trace"].alias("trace"))


@query(
    "SELECT doc_id, CASE WHEN length(text) > 3000 THEN concat(left(text, 3000), chr(10), '... [truncated]') ELSE text END AS text FROM documents"
)
def cap_text(t: Inputs):
    return t.documents.select("doc_id", T.cap_text(F.col("text"), 3000).alias("text"))


@query(
    """SELECT doc_id, position, text FROM (
  SELECT doc_id, unnest(range(len(p))) AS position, unnest(list_transform(p, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS text
  FROM (SELECT doc_id, string_split(body, concat(chr(10), chr(10))) AS p FROM fx_corpus)) WHERE text <> ''"""
)
def split_paragraphs(t: Inputs):
    return T.split_paragraphs(t.fx_corpus).select("doc_id", "position", "text")


@query(
    """SELECT doc_id, length(text) AS chars, len(regexp_extract_all(text, '\\S+')) AS words, CAST(ceil(length(text) / 4.0) AS BIGINT) AS est_tokens,
  ceil(length(text) / 4.0) > 8192 AS over_8192, ceil(length(text) / 4.0) > 10240 AS over_10240,
  ceil(length(text) / 4.0) > 16384 AS over_16384, ceil(length(text) / 4.0) > 32768 AS over_32768 FROM documents"""
)
def length_stats(t: Inputs):
    return T.length_stats(t.documents.select("doc_id", "text")).drop("text")


@query(
    """SELECT conv_id, CAST(turn AS BIGINT) AS turn, text, 'resolved' AS source_set FROM conversations WHERE conv_id IN (SELECT conv_id FROM fx_reports WHERE resolved)
UNION ALL SELECT doc_id, -1, text, 'documents' FROM documents"""
)
def combine_sets(t: Inputs):
    chats = H.select_resolved(t.conversations, t.fx_reports).select("conv_id", "turn", "text")
    docs = t.documents.select(F.col("doc_id").alias("conv_id"), "text")
    both = X.combine_sets({"resolved": chats, "documents": docs}, shuffle_by=["conv_id", "turn"])
    return both.withColumn("turn", F.coalesce("turn", F.lit(-1).cast("bigint")))


@query(
    """
, tagged AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'domain' ELSE 'general' END AS source_set FROM documents),
n AS (SELECT count(*) FILTER (WHERE source_set = 'domain') AS d, count(*) FILTER (WHERE source_set = 'general') AS g FROM tagged),
w AS (SELECT least(floor(d / 0.75::DOUBLE), floor(g / 0.25::DOUBLE)) AS total FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY source_set ORDER BY md5(concat('42:', doc_id)), doc_id) AS p FROM tagged)
SELECT doc_id, source_set FROM r JOIN w ON true
WHERE p <= CASE source_set WHEN 'domain' THEN floor(total * 0.75::DOUBLE) ELSE total - floor(total * 0.75::DOUBLE) END"""
)
def mix(t: Inputs):
    docs = t.documents.select("doc_id", "lang")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    return X.mix(docs.where(english), docs.where(~english), 0.75, ["doc_id"]).select("doc_id", "source_set")


HELD = "CAST(concat('0x', substr(md5(concat('42:', doc_id)), 1, 8)) AS BIGINT) < 0.15::DOUBLE * 4294967296"


@query(f"SELECT doc_id, CASE WHEN {HELD} THEN 'eval' ELSE 'train' END AS split FROM documents")
def split_fraction_hashed(t: Inputs):
    return X.split_fraction(t.documents.select("doc_id"), ["doc_id"], 0.15, exact=False)


@query(
    """SELECT conv_id, CASE WHEN p <= ceil(0.15::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split
FROM (SELECT conv_id, row_number() OVER (ORDER BY md5(concat('42:', conv_id))) AS p, count(*) OVER () AS n FROM v_chat)"""
)
def split_fraction(t: Inputs):
    return X.split_fraction(t.conversations.select("conv_id").distinct(), ["conv_id"], 0.15)


@query(
    f"""SELECT doc_id FROM documents WHERE {HELD} AND text IN (SELECT text FROM documents WHERE NOT ({HELD}))"""
)
def split_leaks(t: Inputs):
    parts = X.split_fraction(t.documents.select("doc_id", "text"), ["doc_id"], 0.15, exact=False)
    held, train = parts.where("split = 'eval'"), parts.where("split = 'train'")
    return X.split_leaks(held, train).select("doc_id")


@query(
    f"""
, para AS (SELECT doc_id, unnest(range(len(p))) AS position, unnest(list_transform(p, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g'))) AS text
  FROM (SELECT doc_id, string_split(body, concat(chr(10), chr(10))) AS p FROM fx_corpus))
SELECT doc_id, position FROM para WHERE text <> '' AND (text IN (SELECT text FROM benchmark)
  OR text IN (SELECT text FROM documents WHERE {HELD}))"""
)
def paragraph_leaks(t: Inputs):
    """Paragraphs that stand in a benchmark, or as a held-out document, word for word."""
    parts = X.split_fraction(t.documents.select("doc_id", "text"), ["doc_id"], 0.15, exact=False)
    paragraphs = T.split_paragraphs(t.fx_corpus)
    leaks = X.split_leaks(paragraphs, t.benchmark.select("text"), parts.where("split = 'eval'"))
    return leaks.select("doc_id", "position")


@query(
    """
, n AS (SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS len, md5(concat('42:', doc_id)) AS h FROM documents WHERE length(text) > 0),
s AS (SELECT *, coalesce(sum(len) OVER (ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS skip FROM n),
e AS (SELECT doc_id, len, skip, unnest(range(skip // 2048, (skip + len - 1) // 2048 + 1)) AS seq FROM s)
SELECT seq, doc_id, greatest(seq * 2048 - skip, 0)::BIGINT AS from_token, least((seq + 1) * 2048 - skip, len)::BIGINT AS to_token FROM e"""
)
def pack_wrap(t: Inputs):
    docs = t.documents.select("doc_id", T.est_tokens(F.col("text")).alias("est_tokens"))
    return P.pack_wrap(docs, 2048)


SHARD = "CAST(concat('0x', substr(md5(concat('42:', doc_id)), 1, 8)) AS BIGINT) % 16"
FULL = "p.fill > 0 AND p.fill + n.tokens > 8192"


@query(
    f"""
, d AS (SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens, {SHARD} AS shard, md5(concat('42:', doc_id)) AS h FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY h, doc_id) AS rn FROM d),
p AS (SELECT shard, rn, doc_id, tokens, 0::BIGINT AS seq, 0::BIGINT AS skip, tokens AS fill FROM n WHERE rn = 1
  UNION ALL
  SELECT n.shard, n.rn, n.doc_id, n.tokens, CASE WHEN {FULL} THEN p.seq + 1 ELSE p.seq END,
    CASE WHEN {FULL} THEN 0 ELSE p.fill END, CASE WHEN {FULL} THEN n.tokens ELSE p.fill + n.tokens END
  FROM p JOIN n ON n.shard = p.shard AND n.rn = p.rn + 1)
SELECT doc_id, tokens, shard, seq, skip AS "offset" FROM p""",
    recursive=True,
)
def pack_greedy(t: Inputs):
    docs = t.documents.select("doc_id", T.est_tokens(F.col("text")).alias("est_tokens"))
    return P.pack_greedy(docs, 8192, shards=16)


@query(
    f"""
, d AS (SELECT doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens, md5(concat('42:', doc_id)) AS h FROM documents),
n AS (SELECT *, row_number() OVER (ORDER BY h, doc_id) AS rn FROM d),
p AS (SELECT rn, doc_id, tokens, 0::BIGINT AS seq, 0::BIGINT AS skip, tokens AS fill FROM n WHERE rn = 1
  UNION ALL
  SELECT n.rn, n.doc_id, n.tokens, CASE WHEN {FULL} THEN p.seq + 1 ELSE p.seq END,
    CASE WHEN {FULL} THEN 0 ELSE p.fill END, CASE WHEN {FULL} THEN n.tokens ELSE p.fill + n.tokens END
  FROM p JOIN n ON n.rn = p.rn + 1)
SELECT doc_id, tokens, seq, skip AS "offset" FROM p""",
    recursive=True,
)
def pack_next_fit(t: Inputs):
    docs = t.documents.select("doc_id", T.est_tokens(F.col("text")).alias("est_tokens"))
    return P.pack_next_fit(docs, 8192)

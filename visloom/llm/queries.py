"""Registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import format_chats
from .decontaminate import benchmark_hits, n_hit
from .fim import fill_in_middle, restored
from .htmltext import extract
from .licenses import scan_licenses
from .linededup import drop_shared_lines
from .neardup import near_duplicates
from .ngram_lm import score_documents
from .packing import pack
from .quality import judge, train
from .repair import counted, damaged, repair
from .rollup import Rollup, count_tokens, deletes, inserts, revisions
from .shared import new_dir, small_batches, store
from .tokenfile import read_documents, write_tokens

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The second tokenizer of op9.
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(_table(spark, sf_dir, "conversations"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(write_tokens(_table(spark, sf_dir, "documents"), TOKENIZER, end_id=1), with_ids=False)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return judge(docs, train(docs, _table(spark, sf_dir, "labels")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def packed_pieces(docs: DataFrame) -> DataFrame:
    """A row a piece of each row of docs (doc_id, text), without the ids but with their crc32; nulls and repeats as in `pack`."""
    packed = pack(docs, TOKENIZER, end_id=2)
    digests = packed.pieces.select("part", "pos", F.crc32("ids").alias("ids_crc32"))
    return packed.placements.join(digests, ["part", "pos"]).drop("part", "pos")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    n = n_hit()
    return hits.select("doc_id", "n_words", n.alias("n_hit"), (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (n > 0).alias("contaminated"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger's life: all documents come in; those of bad label go; source src0 is counted anew by another tokenizer.

    Each batch is committed twice, as after a retry, and the ledger is compacted before the last.
    """
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    folder = new_dir(spark, "rollup")
    texts = docs.select("doc_id", "source", "lang", "text", F.when(F.col("source") == "src0", F.col("text")).alias("again"))
    rows = count_tokens(count_tokens(texts, TOKENIZER).withColumnRenamed("again", "text"), BYTES, "new_n_tokens")
    rows = store(rows, folder, "counts").withColumn("tokenizer", F.lit("word_bpe_49k"))
    bad = labels.where("quality = 0").select("doc_id").distinct()
    anew = rows.where("source = 'src0'").join(bad, "doc_id", "left_anti")
    anew = anew.select("source", "lang", F.col("tokenizer").alias("old_tokenizer"), F.col("n_tokens").alias("old_n_tokens"), F.lit("byte_bpe_50k").alias("new_tokenizer"), "new_n_tokens")
    changes = {"1": inserts(rows), "2": deletes(rows.join(bad, "doc_id", "left_semi")), "3": revisions(anew)}
    rollup = Rollup(spark, f"{folder}/ledger")
    for batch, some in changes.items():
        rollup.commit(batch, some)
        rollup.commit(batch, some)
        if batch == "2":
            rollup.compact()
    return rollup.totals()


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counted(repair(damaged(_table(spark, sf_dir, "conversations"))))
    return found.withColumn("repaired_sha256", F.sha2(F.array_join("repaired", "\n"), 256)).drop("repaired")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, cut_percent=50, suffix_first_percent=80)
    return found.withColumns({"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256)}).drop("output")


#: Words are parts between the six white-space characters; shingles are joined by a blank, which no word holds.
OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * m >= 80 * (na.n + nb.n - m)
), e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT r.id, e2.b FROM r JOIN e2 ON e2.a = r.c)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""

#: Windows are joined by blanks, which no word holds; a document word is hit if a window that covers it occurs.
OP8_SQL = r"""
WITH low AS (
  SELECT doc_id, 'd' AS kind, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT item_id, 'b', translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), w AS (
  SELECT doc_id AS id, kind, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM low
), g AS (
  SELECT DISTINCT id AS item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM w WHERE kind = 'b' AND len(w) > 0)
), dw AS (
  SELECT id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (SELECT DISTINCT k FROM g) WHERE kind = 'd' AND len(w) >= k)
), hit AS (SELECT dw.id, dw.i, dw.k, g.item_id FROM dw JOIN g ON g.g = dw.g AND g.k = dw.k),
n AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l FROM (SELECT DISTINCT id, item_id FROM hit) GROUP BY id)
SELECT w.id AS doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN n ON n.id = w.id LEFT JOIN items ON items.id = w.id WHERE kind = 'd'
"""

OP1_SQL = r"""
WITH c AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS l,
    string_agg('<|turn|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS chat
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
)
SELECT conv_id, len(l)::BIGINT AS n_turns, chat, length(chat)::BIGINT AS n_chars FROM c
WHERE NOT EXISTS (
  SELECT 1 FROM c AS o WHERE o.conv_id <> c.conv_id AND o.l[1] IS NOT DISTINCT FROM c.l[1] AND len(o.l) >= len(c.l) AND o.l[1 : len(c.l)] = c.l
    AND (len(o.l) > len(c.l) OR o.conv_id < c.conv_id)
)
"""

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP11_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (
  SELECT doc_id, r, i, l[i] AS line, translate(trim(l[i], {_BLANKS}), '{_UPPER}', '{_SMALL}') AS k
  FROM (SELECT doc_id, r, l, unnest(generate_series(1, len(l))) AS i FROM d)
), c AS (SELECT k, max(doc_id) AS keeper FROM x WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT r) >= 5),
y AS (SELECT x.*, c.k IS NOT NULL AND keeper IS DISTINCT FROM doc_id AS dropped FROM x LEFT JOIN c USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM y GROUP BY doc_id, r
"""


def _op12_sql() -> str:
    """Forwards as the search goes, the SQL goes backwards: for each of four states the least `cost and audit` text of what is left.

    Costs have nine digits, so texts compare as (cost, audit). A step of the fold is a row, or `+`: up to two insertions.
    """
    none = "'999999999'"
    add = lambda cost, edit, s: f"CASE WHEN {s} = {none} THEN {none} ELSE printf('%09d', substr({s}, 1, 9)::BIGINT + {cost}) || '{edit}' || substr({s}, 10) END"
    grown, a = (3, 3, 4, 3), [f"a[{q}]" for q in range(1, 5)]

    def row(c: str) -> str:
        more, low, out = int(c.isupper()), c.lower(), []
        for q in range(4):
            ways = [add(3, "D", a[q])]
            if c != "-":
                to = {"s": (2, 0, 0, 0), "u": (3, 3, 0, 3), "a": (0, 0, 4, 0), "e": (1, 2, 3, 4), "x": (0, 0, 0, 0)}[low][q]
                ways += [add(more, "K", a[to - 1])] if to else []
                ways.append(add(2 + more, "R", a[grown[q] - 1]))
            out.append(f"least({', '.join(ways)})")
        return f"[{', '.join(out)}]"

    def inserted(q: int) -> str:
        once = grown[q]
        return f"least({a[q]}, {add(2, 'I', a[once - 1])}, {add(4, 'II', a[grown[once - 1] - 1])})"

    cases = " ".join(f"WHEN '{c}' THEN {row(c)}" for c in "suaexSUAEX-")
    step = f"CASE x WHEN '+' THEN [{', '.join(map(inserted, range(4)))}] {cases} END"
    crc = "xor(list_reduce(flatten(list_transform(string_split(p, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x::BIGINT) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295)"
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS p FROM conversations
), k AS (SELECT *, {crc} % 20 AS k FROM c),
d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(generate_series(1, CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM k)
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again, rtrim(text, {_BLANKS}) AS bare FROM d
), f AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, left(role, 1) AS initial FROM n
), s AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN '-' WHEN fault = 'truncated' THEN upper(small) ELSE small END AS shape,
    lag(initial) OVER w || initial AS pair
  FROM (SELECT *, CASE WHEN initial IN ('s', 'u', 'a') THEN initial WHEN initial = '' THEN 'e' ELSE 'x' END AS small FROM f) WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list(shape ORDER BY i DESC) AS shapes, list({{'r': role, 't': text}} ORDER BY i) AS rows
  FROM s GROUP BY conv_id
), e AS (
  SELECT *, list_reduce(flatten(list_transform(shapes, lambda x: [x, '+'])), lambda a, x: {step}, ['000000000', '000000004II', '000000002I', '000000000'])[1] AS best FROM g
), w AS (
  SELECT conv_id, rows, substr(best, 10) AS audit, 1 AS pos, 0 AS used, 0 AS state, []::VARCHAR[] AS out FROM e
  UNION ALL
  SELECT conv_id, rows, audit, pos + 1, used + (o <> 'I')::INT, CASE WHEN line IS NULL OR one = '' THEN state WHEN one = 's' THEN 1 WHEN one = 'u' THEN 2 ELSE 3 END, CASE WHEN line IS NULL THEN out ELSE list_append(out, line) END
  FROM (SELECT *, CASE o WHEN 'D' THEN NULL WHEN 'K' THEN rows[used + 1].r || ':' || rows[used + 1].t WHEN 'I' THEN role || ':' ELSE role || ':' || rows[used + 1].t END AS line, left(CASE o WHEN 'K' THEN rows[used + 1].r ELSE role END, 1) AS one
    FROM (SELECT *, substr(audit, pos, 1) AS o, CASE state WHEN 2 THEN 'assistant' ELSE 'user' END AS role FROM w WHERE pos <= length(audit)))
), z AS (SELECT conv_id, sha256(array_to_string(out, chr(10))) AS h FROM w WHERE pos = length(audit) + 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(substr(best, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit, coalesce(z.h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id
"""


OP12_SQL = _op12_sql()

OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents
), c AS (
  SELECT doc_id, text, w, len(w) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(w) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(w) + 1) AS c2,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t
), p AS (
  SELECT *, array_to_string(w[1 : least(c1, c2)], '') AS p, array_to_string(w[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m, array_to_string(w[greatest(c1, c2) + 1 : n], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_token_file": op2_token_file,
    "op3_lm_scores": op3_lm_scores,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_license_scan": op6_license_scan,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_html_text": op10_html_text,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op4_minhash_near_dedup": OP4_SQL,
    "op8_decontamination": OP8_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}

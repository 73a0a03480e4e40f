"""The registered queries of this subpackage, with production parameters, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbsight.llm.chat_format import format_preferences, replaced_replies
from kerbsight.llm.decontaminate import contaminated
from kerbsight.llm.exact_dedup import exact_dedup
from kerbsight.llm.hard_negatives import hard_negatives
from kerbsight.llm.jaccard_join import jaccard_components
from kerbsight.llm.line_dedup import drop_frequent_lines
from kerbsight.llm.mixing import mixed, n_words
from kerbsight.llm.quality import fit, score_quality
from kerbsight.llm.runtime import crc_bucket, table
from kerbsight.llm.sentencepiece_codec import encode
from kerbsight.llm.spelling import spelling_variants, word_counts
from kerbsight.llm.suffix_dedup import remove_repeats
from kerbsight.llm.toxicity import score_toxicity
from kerbsight.llm.url_filter import Rule, filter_urls

RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against its counterpart with replaced last turns; spans as text."""
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ";")
    pairs = format_preferences(replaced_replies(table(spark, sf_dir, "conversations")))
    return pairs.select("pair_id", "n_common", "prompt", "chosen", spans(F.col("chosen_spans")).alias("chosen_mask"), "rejected", spans(F.col("rejected_spans")).alias("rejected_mask"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines, and how many went."""
    cleaned = drop_frequent_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "source", F.col("_n_dropped").alias("n_dropped"), "text")


#: From this score on a document's quality is predicted as 1, or its toxicity.
QUALITY_CUT, TOXIC_CUT = 0.3, 0.5


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, from its text alone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_bucket("doc_id") == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= QUALITY_CUT).cast("int").alias("predicted"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest rule and verdict of every page."""
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with each benchmark item that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, from its text alone."""
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (crc_bucket("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"), "ratio", "n_words")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that start in an earlier one."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts, and its text's digest."""
    return exact_dedup(table(spark, sf_dir, "documents"), digest_col="text_sha256")


#: The piece model of the ninth operator, a vocabulary file outside the repository.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = PIECES) -> DataFrame:
    """Ids of each whole text, and whether decoding them gives it back."""
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path, check=True)
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and its component of near duplicates."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus, a known share of whose occurrences is misspelt, with the frequent word next to it."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), min_points=7, every=31), min_count=2, ratio=10)


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and how many of its words the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    taken = (F.col("_copies") * F.col("size")).alias("taken")
    return mixed(docs, "size", weights=(5, 2, 1), most=3).select("doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the first rows of the same label of every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_url_filters": op4_url_filters,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_source_mixing": op12_source_mixing,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op1_chat_formatting": r"""
with c as (select conv_id as pair_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
l as (select pair_id, max(turn) as last from c group by pair_id),
m as (select c.*, l.last from c join l using (pair_id)),
sides as (
  select pair_id, 'c' as side, turn, role, text from c
  union all select pair_id, 'r', turn, role, text from m where turn is distinct from last
  union all select l.pair_id, 'r', l.last, m.role, m.text from m join l on l.pair_id = m.pair_id - 1 where m.turn is not distinct from m.last),
n as (select *, row_number() over (partition by pair_id, side order by turn nulls first, role, text) as k,
        '<|' || role || '|>' || chr(10) as head, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as body from sides),
j as (select coalesce(a.pair_id, b.pair_id) as pair_id, coalesce(a.k, b.k) as k,
        coalesce(a.role = b.role and a.text = b.text, false) as same
      from (select * from n where side = 'c') a full join (select * from n where side = 'r') b on a.pair_id = b.pair_id and a.k = b.k),
p as (select pair_id, coalesce(min(case when not same then k end) - 1, max(k)) as n_common from j group by pair_id),
s as (select n.*, p.n_common,
        coalesce(sum(length(body)) over (partition by n.pair_id, side, n.k > p.n_common order by n.k rows between unbounded preceding and 1 preceding), 0) as base
      from n join p using (pair_id))
select pair_id, cast(any_value(n_common) as integer) as n_common,
  coalesce(string_agg(body, '' order by k) filter (where side = 'c' and k <= n_common), '') as prompt,
  coalesce(string_agg(body, '' order by k) filter (where side = 'c' and k > n_common), '') as chosen,
  coalesce(string_agg(cast(base + length(head) as bigint) || '-' || cast(base + length(body) as bigint), ';' order by k) filter (where side = 'c' and k > n_common and role = 'assistant'), '') as chosen_mask,
  coalesce(string_agg(body, '' order by k) filter (where side = 'r' and k > n_common), '') as rejected,
  coalesce(string_agg(cast(base + length(head) as bigint) || '-' || cast(base + length(body) as bigint), ';' order by k) filter (where side = 'r' and k > n_common and role = 'assistant'), '') as rejected_mask
from s group by pair_id""",
    "op2_line_dedup": r"""
with d as (select doc_id, source, coalesce(source, '') as host, text from documents),
p as (select distinct host, coalesce(text, '') as body from d),
t as (select host, count(*) as total from p group by host),
l as (select distinct host, body, regexp_replace(unnest(string_split(body, chr(10))), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as line from p),
b as (select host, line from l join t using (host) where line <> '' group by host, line, total having count(*) >= 5 and count(*) > 0.05 * total),
x as (select doc_id, host, generate_subscripts(string_split(text, chr(10)), 1) as k, unnest(string_split(text, chr(10))) as line from d),
k as (select x.*, b.line is not null as gone from x left join b on b.host = x.host and b.line = regexp_replace(x.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')),
a as (select doc_id, count(*) filter (where gone) as n_dropped, coalesce(string_agg(line, chr(10) order by k) filter (where not gone), '') as text from k group by doc_id)
select d.doc_id, d.source, coalesce(a.n_dropped, 0) as n_dropped, a.text from d left join a using (doc_id)""",
    "op4_url_filters": r"""
with u as (select page_id,
    case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, rest, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from u),
r(rh, rp, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m as (select page_id, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(v, length(rh || rp)) as v
    from h join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
select h.page_id, host, path, rule, coalesce(v, 'allow') as verdict from h left join m using (page_id)""",
    "op8_exact_dedup": r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
  row_number() over (partition by text_sha256 order by doc_id nulls last) = 1 as kept, text_sha256 from d""",
    "op11_spelling_variants": r"""
with recursive bits as (select list_transform(range(256), lambda c: list_reduce(range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, c)) as t),
o as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w from documents),
d as (select doc_id, w, count(*) as n, coalesce(cast(doc_id as varchar), '') || ':' || w as s from o where length(w) >= 7 group by doc_id, w),
h as (select w, n, xor(list_reduce(list_transform(range(1, strlen(s) + 1), lambda i: cast('0x' || substr(hex(s), 2 * i - 1, 2) as bigint)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) as h from d, bits),
m as (select case when h % 31 = 0 then substr(w, 1, cast(h % length(w) as bigint)) || substr(w, cast(h % length(w) as bigint) + 2) else w end as w, n from h),
c as (select w as word, cast(sum(n) as bigint) as n from m where length(w) >= 7 group by w having sum(n) >= 2),
g as (select word, unnest(range(1, length(word) + 1)) as k from c),
x as (select word, k, substr(word, 1, k - 1) || substr(word, k + 1) as s from g),
p as (select a.word, b.word as other from x a join x b on a.s = b.s and a.k = b.k and a.word <> b.word
  union select x.word, c.word from x join c on x.s = c.word union select c.word, x.word from x join c on x.s = c.word),
b as (select p.word, count(*) as n_near, min(struct_pack(n := -c.n, w := p.other)) as best from p join c on c.word = p.other group by p.word),
f as (select c.word, c.n, coalesce(b.n_near, 0) as n_near, case when -b.best.n >= 10 * c.n then b.best.w end as form, case when -b.best.n >= 10 * c.n then -b.best.n end as form_n from c left join b using (word)),
r as (select word, form as at from f where form is not null union all select r.word, f.form from r join f on f.word = r.at where f.form is not null),
e as (select r.word, r.at as root from r join f on f.word = r.at where f.form is null)
select f.word, f.form, coalesce(e.root, f.word) as root, f.n, f.n_near, f.form_n from f left join e using (word)""",
    "op12_source_mixing": r"""
with s as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
t as (select source, cast(sum(size) as bigint) as source_size, count(*) as n_docs, row_number() over (order by source nulls last) as k from s group by source),
w as (select *, case (k - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w, 3 * source_size as most from t),
c as (select *, cast(source_size as double) / w as ratio from w),
r as (select *, sum(source_size) over () - coalesce(sum(most) over (order by ratio, k rows between unbounded preceding and 1 preceding), 0) as open,
  sum(w) over () - coalesce(sum(w) over (order by ratio, k rows between unbounded preceding and 1 preceding), 0) as rest from c),
l as (select open, rest from r where cast(most as hugeint) * rest >= cast(open as hugeint) * w order by ratio, k limit 1),
g as (select source, source_size, n_docs, least(cast(most as double), cast(w * l.open as double) / cast(l.rest as double)) as target,
  cast('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 6) as bigint) as start from c, l),
q as (select *, case when source_size > 0 then least(cast(floor(target / source_size * 16777216.0) as bigint), 50331648) else 0 end as rate from g),
n as (select s.doc_id, s.size, q.*, row_number() over (partition by s.source order by s.size, s.doc_id nulls first) - 1 as k from s join q on s.source is not distinct from q.source),
p as (select *, case when k % 2 = 0 then k // 2 else n_docs - (k + 1) // 2 end as place from n)
select doc_id, size, source_size, target, cast(size * (((start + (place + 1) * rate) >> 24) - ((start + place * rate) >> 24)) as bigint) as taken from p""",
    "op13_hard_negatives": r"""
with e as (select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as integer) as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, e.vec_id, a.label = e.label as alike, cast(list_dot_product(a.v, e.v) as bigint) as score from e a join e on a.vec_id <> e.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by anchor_id order by score desc, vec_id) as k from s where alike),
n as (select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from p join s on s.anchor_id = p.anchor_id where k <= 5 and not s.alike and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5""",
}

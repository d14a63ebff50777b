"""The registered queries of the operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, bag_minhash, bpe, chat, decontaminate, lexical_search, pii, quality_rules, substring_dedup, token_files, unigram_counts, url_filter, warc
from tidemark.llm.common import read_table
from tidemark.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op6_bpe(spark: SparkSession, sf_dir: str, tokenizer_path: str = WORD_BPE) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    return bpe.encode_texts(read_table(spark, sf_dir, "documents"), tokenizer_path, ["doc_id"], full=False)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the base and the certified rules."""
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bag_minhash.classes(read_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window."""
    return decontaminate.digest(decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


OP2_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
p as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + 9], ' ') as phrase
      from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
k as (select distinct n, phrase from p),
s as (select distinct n from k),
o as (select doc_id, i, n, phrase from (
        select doc_id, i, s.n, array_to_string(w[i : i + s.n - 1], ' ') as phrase
        from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d) cross join s where i + s.n - 1 <= len(w)) join k using (n, phrase)),
h as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from o) group by 1),
t as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, item_id::varchar as id from o join p using (n, phrase)) group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)"""

def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and the number of mentions."""
    return pii.replace_mentions(read_table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_mentions")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word passages that an earlier document has."""
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), full=False)


OP1_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
x as (select doc_id, i, array_to_string(w[i : i + 12], ' ') as words from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
m as (select words, min(doc_id) as least from x group by 1),
r as (select distinct doc_id, unnest(range(i, i + 13)) as j from x join m using (words) where least < doc_id),
k as (select doc_id, string_agg(word, ' ' order by j) as kept, count(*) as n from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from d) anti join r using (doc_id, j) group by 1)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)"""

def op4_token_counts(spark: SparkSession, sf_dir: str, model_path: str = PIECES) -> DataFrame:
    """Number of unigram tokens of every document."""
    return unigram_counts.count_tokens(read_table(spark, sf_dir, "documents"), model_path, ["doc_id"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, as read back from the archives that it was written to."""
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    read = warc.read_archives(manifest)
    digest = F.when(F.col("verified"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("a record's digests don't fit: "), F.coalesce("url", F.lit("")))))
    return read.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


OP5_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as payload_bytes, sha1(b) as hex from p),
f as (select payload_bytes, hex, min(page_id) as first from d group by all),
x as (select *, list_transform(range(8), lambda i: ('0x' || substr(hex, (5 * i + 1)::int, 5))::bigint) as v from d)
select page_id, payload_bytes,
  array_to_string(list_transform(v, lambda n: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> 15) & 31)::int + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> 10) & 31)::int + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> 5) & 31)::int + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (n & 31)::int + 1, 1)), '') as payload_digest,
  case when first = page_id then 'response' else 'revisit' end as record_type, case when first != page_id then first end as refers_to
from x join f using (payload_bytes, hex)"""


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, as read back from its formatted segments."""
    segments = chat.format_conversations(chat.with_probe(read_table(spark, sf_dir, "conversations")))
    return chat.digests(chat.read_turns(segments))


OP8_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)))::bigint as formatted_chars
from c group by 1"""


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer_path: str = BYTE_BPE) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back from the files."""
    manifest = token_files.write_files(read_table(spark, sf_dir, "documents"), tokenizer_path, scratch_path(spark, "token-ids"))
    return token_files.read_documents(manifest)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
i as (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
s as (select count(*) as n_docs, sum(len(w))::bigint as n_terms from d where len(w) > 0),
tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from d) where term in (select term from i) group by 1, 2),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from tf cross join s group by term, n_docs),
m as (select doc_id, 25 + (75 * len(w) * n_docs) // n_terms as m from d cross join s),
x as (select item_id, doc_id, sum(weight * c * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from (select item_id, term, count(*) as c from i group by 1, 2) join tf using (term) join w using (term) join m using (doc_id) group by 1, 2),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from x where score > 0)
select * from r where rank <= 10"""


# --- fixed values: the rules of the contract (host, path, action) ---
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
# --- end of fixed values ---


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the allow and block rules on the url of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(read_table(spark, sf_dir, "pages"), rules, ["page_id"])


OP12_SQL = """
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as a from pages),
h as (select page_id, a, regexp_extract(a, '^[^/?#]*', 0) as raw from u),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(substr(a, length(raw) + 1), '^[^?#]*', 0) as path from h),
r(rule_host, rule_path, action) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
select page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, coalesce(arg_max(action, length(rule_host || rule_path)), 'allow') as verdict
from p left join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by page_id, host, path"""


def op13_token_alignment(spark: SparkSession, sf_dir: str, a_path: str = BYTE_BPE, b_path: str = PIECES) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, per document, with corpus-wide counts."""
    return alignment.align_tokens(read_table(spark, sf_dir, "documents"), a_path, b_path, ["doc_id"])


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_decontaminate, op3_pii, op4_token_counts, op5_warc, op6_bpe, op7_quality_rules, op8_chat, op9_token_files, op10_bag_minhash, op11_lexical_search, op12_url_filter, op13_token_alignment)}
ORACLE: dict[str, str] = {"op1_substring_dedup": OP1_SQL, "op2_decontaminate": OP2_SQL, "op5_warc": OP5_SQL, "op8_chat": OP8_SQL, "op11_lexical_search": OP11_SQL, "op12_url_filter": OP12_SQL}

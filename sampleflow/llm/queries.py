"""The registered queries of this package, each on its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleflow.llm.bpe import decode_ids, encode_texts
from sampleflow.llm.chat import chat_digests, format_chat
from sampleflow.llm.exact import exact_groups
from sampleflow.llm.language import held_out, identify, train_network
from sampleflow.llm.mixing import mix_sources
from sampleflow.llm.ngram_join import ngram_links
from sampleflow.llm.page_text import main_text
from sampleflow.llm.phrases import collocations
from sampleflow.llm.prefix_trie import prefix_trie
from sampleflow.llm.quality import judge_quality, train_quality
from sampleflow.llm.sharding import balanced_shards
from sampleflow.llm.substrings import remove_repeats
from sampleflow.llm.urls import Rule, url_verdicts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CHAT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
URL_RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
SEED = 7


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register()
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_links(table(spark, sf_dir, "documents"), size=3, percent=90)


@register()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train_network(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register(
    f"""
    WITH sized AS (
        SELECT doc_id, source,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
            md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS k
        FROM documents
    ),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
        FROM sized GROUP BY source
    ),
    -- Sources in the order in which they are full; one is full if the share left for it would be above its cap.
    shares AS (
        SELECT *, 3 * source_size AS cap,
            sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain,
            sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
        FROM sources WINDOW f AS (ORDER BY (3 * source_size)::DOUBLE / w, source)
    ),
    level AS (
        SELECT first(remain ORDER BY cap::DOUBLE / w, source) AS remain, first(weights ORDER BY cap::DOUBLE / w, source) AS weights
        FROM shares WHERE remain * w < cap * weights
    ),
    targets AS (
        SELECT s.source, s.source_size,
            CASE WHEN s.remain * s.w >= s.cap * s.weights THEN s.cap::DOUBLE
                 ELSE (l.remain * s.w)::DOUBLE / l.weights::DOUBLE END AS target
        FROM shares s, level l
    ),
    plan AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
    ),
    ordered AS (
        SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
            p.target - (p.whole * p.source_size)::DOUBLE AS rest,
            sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS UNBOUNDED PRECEDING) AS upto
        FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
    )
    SELECT doc_id, size, source_size, target,
        (size * (whole + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM ordered
    """
)
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), (1, 2, 3), max_epochs=3, seed=SEED)
    taken = F.col("size") * F.col("repeats")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@register()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge_quality(docs, train_quality(docs, table(spark, sf_dir, "labels")))


def _url_sql(rules: tuple[Rule, ...], depth: int = 4, least: int = 6) -> str:
    """The whole of ``url_verdicts`` by its default options, for labelled URLs of up to ``depth`` segments (two on the given tables)."""
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name} {r.verdict}'"
        for r in sorted(rules, key=lambda r: (-len(r.name), r.name))
    )
    levels = "".join(
        f"""
    named{d} AS (
        SELECT host, t, segs[{d + 1}] AS seg FROM r{d} WHERE len(segs) > {d} AND found IS NOT NULL
        GROUP BY ALL HAVING count(*) >= {least}
    ),
    r{d + 1} AS (
        SELECT r.* EXCLUDE (t), CASE WHEN len(segs) <= {d} THEN r.t
            ELSE r.t || '/' || CASE WHEN n.t IS NULL THEN '*' ELSE segs[{d + 1}] END END AS t
        FROM r{d} r LEFT JOIN named{d} n ON r.host = n.host AND r.t = n.t AND segs[{d + 1}] = n.seg
    ),"""
        for d in range(depth)
    )
    return f"""
    WITH rests AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ),
    hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rests),
    paths AS (
        SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path
        FROM hosts
    ),
    r0 AS (
        SELECT *, CASE {cases} END AS found, '' AS t,
            list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
                lambda x: regexp_replace(regexp_replace(x, '\\.[A-Za-z]{{1,5}}$', ''), '^[0-9]+$', '*')) AS segs
        FROM paths
    ),{levels}
    judged AS (
        SELECT page_id, host, path, string_split(found, ' ')[1] AS rule, string_split(found, ' ')[2] AS verdict,
            t || repeat('/*', greatest(len(segs) - {depth}, 0)) AS template
        FROM r{depth}
    ),
    stats AS (
        SELECT host, template, string_split(template, '/') AS parts, count(verdict) AS n,
            count(*) FILTER (verdict = 'block') AS bad, count(*) AS total
        FROM judged GROUP BY host, template
    ),
    neighbours AS (
        SELECT *, lag(n) OVER s AS n0, lag(bad) OVER s AS bad0
        FROM stats WHERE n > 0 WINDOW s AS (PARTITION BY host, len(parts) ORDER BY bad / n, template)
    ),
    runs AS (
        SELECT *, sum(CASE WHEN n0 IS NULL THEN 1 WHEN abs(bad / n - bad0 / n0)
                > 2 * sqrt(((bad + bad0) / (n + n0)) * (1 - (bad + bad0) / (n + n0)) * (1 / n + 1 / n0)) THEN 1 ELSE 0 END) OVER s AS run
        FROM neighbours WINDOW s AS (PARTITION BY host, len(parts) ORDER BY bad / n, template)
    ),
    nodes AS (
        SELECT host, template, n, bad, total, level, array_to_string(parts[1:level], '/') AS node
        FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS level FROM stats)
    ),
    above AS (SELECT host, node, sum(n) AS n, sum(bad) AS bad, sum(total) AS total FROM nodes GROUP BY host, node HAVING sum(n) > 0),
    counted AS (
        SELECT host, template, min(template) OVER b AS branch, sum(n) OVER b AS n, sum(bad) OVER b AS bad, sum(total) OVER b AS total
        FROM runs WINDOW b AS (PARTITION BY host, len(parts), run)
        UNION ALL
        SELECT s.host, s.template, coalesce(arg_max(a.node, level), s.template), coalesce(arg_max(a.n, level), 0),
            coalesce(arg_max(a.bad, level), 0), coalesce(arg_max(a.total, level), 0)
        FROM nodes s LEFT JOIN above a ON s.host = a.host AND s.node = a.node
        WHERE s.n = 0 AND (a.n > 0 OR level = 1) GROUP BY s.host, s.template
    ),
    branches AS (
        SELECT host, template, branch, n::BIGINT AS evidence,
            (bad + 0.5::DOUBLE * (4 + 0.5::DOUBLE * (total - n))) / (n + (4 + 0.5::DOUBLE * (total - n))) AS purity
        FROM counted
    )
    SELECT page_id, host, path, rule, template, branch, purity, evidence,
        coalesce(verdict, CASE WHEN purity >= 0.8::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged JOIN branches USING (host, template)
    """


@register(_url_sql(URL_RULES))
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


@register()
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    formatted = format_chat(turns, CHAT_RANKS, public_tokenizers.PATTERN)
    return chat_digests(formatted, CHAT_RANKS, public_tokenizers.PATTERN)


@register()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encode_texts(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)
    return decode_ids(ids, BPE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register()
def op8_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), shards=40)


@register()
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), size=20, with_text=False)


@register(
    """
    WITH normal AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
    FROM normal WINDOW same AS (PARTITION BY t)
    """
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), all_hashes=True)


# For pages whose text stands in one article, as on all given tables; the tests have others.
@register(
    """
    WITH bodies AS (
        SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h1)>') AS parts
        FROM pages
    ),
    blocks AS (
        SELECT page_id, url, list_filter(list_transform(parts, lambda b: trim(regexp_replace(
            replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', ' ', 'g'),
                '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
            '[\\s\\x0B\\x1C-\\x1F\\x{85}\\x{A0}]+', ' ', 'g'))), lambda b: b <> '') AS lines
        FROM bodies
    )
    SELECT page_id, url, array_to_string(lines, chr(10) || chr(10)) AS text, length(array_to_string(lines, chr(10) || chr(10))) AS n_chars
    FROM blocks
    """
)
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@register(
    """
    WITH said AS (
        SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ),
    -- CRC-32 of the decimal number, bit by bit.
    borrowed AS (
        SELECT *, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384::BIGINT) ELSE s // 2 END)), 4294967295::BIGINT) % 9)::INTEGER AS h
        FROM said
    ),
    built AS (
        SELECT b.c, list_concat(coalesce(o.own, [])[1:b.h], b.own[b.h + 1:]) AS turns
        FROM borrowed b LEFT JOIN said o ON o.c = b.c - b.c % 5
    ),
    prefixes AS (SELECT c, turns, d, turns[1:d] AS prefix FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
    nodes AS (
        SELECT prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len(turns)), '')) AS ends_sha256
        FROM prefixes GROUP BY prefix, d
    ),
    -- A node is named by its smallest member and its depth; its ancestors are those of that member.
    kids AS (
        SELECT p.conv_id, p.depth, count(*) AS n_children
        FROM nodes n JOIN prefixes m ON m.c = n.conv_id AND m.d = n.depth - 1 JOIN nodes p ON p.depth = m.d AND p.prefix = m.prefix
        GROUP BY ALL
    ),
    own AS (
        SELECT n.*, coalesce(k.n_children, 0) AS n_children,
            CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * strlen(n.prefix[n.depth].text) ELSE 0 END AS saved
        FROM nodes n LEFT JOIN kids k USING (conv_id, depth)
    ),
    subtrees AS (
        SELECT a.conv_id, a.depth, count(*) FILTER (n.n_children = 0) AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
        FROM own n JOIN prefixes m ON m.c = n.conv_id AND m.d <= n.depth JOIN nodes a ON a.depth = m.d AND a.prefix = m.prefix
        GROUP BY ALL
    )
    SELECT o.conv_id, o.depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
    FROM own o JOIN subtrees s USING (conv_id, depth)
    LEFT JOIN prefixes m ON m.c = o.conv_id AND m.d = o.depth - 1 LEFT JOIN nodes up ON up.depth = m.d AND up.prefix = m.prefix
    """
)
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


@register(
    """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ),
    spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    said AS (SELECT lang, sum(len(w))::BIGINT AS n FROM spoken GROUP BY lang),
    grams AS (
        SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS g
        FROM spoken, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
    ),
    f AS (SELECT lang, size, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
    cuts AS (
        SELECT lang, size, g, a, k, array_to_string(string_split(g, ' ')[1:k], ' ') AS one, array_to_string(string_split(g, ' ')[k + 1:], ' ') AS two
        FROM f, (SELECT unnest([1, 2]) AS k) WHERE k < size
    ),
    scored AS (
        SELECT c.lang, c.size, c.g, c.a, x.a AS l, y.a AS r,
            ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score, k
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.one JOIN f y ON y.lang = c.lang AND y.g = c.two
    ),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    longer AS (
        SELECT lang, part, max(a) AS most
        FROM (SELECT lang, a, unnest([array_to_string(string_split(g, ' ')[1:2], ' '), array_to_string(string_split(g, ' ')[2:3], ' ')]) AS part
            FROM f WHERE size = 3)
        GROUP BY ALL
    )
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
    FROM least s JOIN said USING (lang) LEFT JOIN longer o ON o.lang = s.lang AND o.part = s.g
    WHERE most IS NULL OR 100 * most < 50 * a
    QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, g) <= 2000
    """
)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=10, longest=3, top=2000, inside=50)


@register()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)

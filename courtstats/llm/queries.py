"""The registered queries of this subpackage, with the SQL that checks them."""

from courtstats.llm.decontaminate import contamination
from courtstats.llm.merkle import ARITY, FIELDS, verified_manifest
from courtstats.llm.minhash import near_duplicates
from courtstats.llm.packing import pack
from courtstats.llm.quality import LEAST_WORDS, MOST_REPEATED, RULES, STOP_WORDS, quality
from courtstats.llm.suffix_dedup import repeat_report
from courtstats.llm.super_kmers import earlier_windows
from courtstats.llm.tables import table
from courtstats.llm.token_counts import token_counts
from courtstats.llm.tool_calls import SCHEMAS, derived_traffic, tool_messages
from courtstats.llm.toxicity import score_texts
from courtstats.llm.url_filter import filter_urls
from courtstats.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, vector_codes
from courtstats.llm.warc import archived

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


@query("op4_minhash_near_dedup")
def op4(spark, sf_dir):
    """Near duplicates of the documents over shingles of four words."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, size=4).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query("op1_suffix_array_dedup")
def op1(spark, sf_dir):
    """Bytes of the documents that strings of 400 bytes repeat."""
    return repeat_report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    """Token counts of the documents, and which are over 512."""
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op5_packing")
def op5(spark, sf_dir):
    """The documents packed into sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_benchmark_decontamination")
def op8(spark, sf_dir):
    """Documents that hold words of a benchmark item."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@query(
    "op10_warc_archive",
    """
    with p as (
        select page_id, coalesce(html, '') as html from pages
    ), d as (
        select page_id, html, sha1(html) as hex,
            max(page_id) over (partition by sha256(html)) as last
        from p
    ), v as (
        select *, list_transform(range(0, 8),
            lambda i: ('0x' || hex[5 * i + 1 : 5 * i + 5])::bigint) as groups
        from d
    )
    select page_id,
        strlen(html)::bigint as payload_bytes,
        list_aggregate(list_transform(range(0, 32),
            lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (groups[i // 4 + 1] >> (15 - 5 * (i % 4))) % 32 + 1, 1)),
            'string_agg', '') as payload_digest,
        case when page_id = last then 'response' else 'revisit' end as record_type,
        case when page_id <> last then last end as refers_to
    from v
    """,
)
def op10(spark, sf_dir):
    """Records of the pages, archived with each payload once and read back."""
    return archived(table(spark, sf_dir, "pages", "page_id", "url", "html"), least_bytes=0)


def _rules_sql():
    parts = []
    for r in RULES:
        if r.least is not None:
            parts.append(f"100 * {r.part} >= {r.least} * {r.whole}")
        if r.most is not None:
            parts.append(f"100 * {r.part} <= {r.most} * {r.whole}")
    return " and ".join(parts)


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(
    "op6_quality_rules",
    rf"""
    with t as (
        select doc_id, coalesce(text, '') as text from documents
    ), w as (
        select doc_id, text,
            list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
            list_filter(string_split(text, chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
        from t
    ), triples as (
        select doc_id, i, words[i : i + 2] as triple
        from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)
    ), again as (
        select doc_id, i from triples
        qualify count(*) over (partition by doc_id, triple) > 1
    ), covered as (
        select doc_id, count(distinct i + k) as n
        from again, range(0, 3) as r(k) group by doc_id
    ), facts as (
        select w.doc_id, len(words) as n_words,
            coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
            coalesce(covered.n, 0) as n_repeat_words,
            len(lines) as n_lines,
            len(list_filter(words, lambda x: lower(x) in ({_STOP_SQL}))) as n_stop_words
        from w left join covered on w.doc_id = covered.doc_id
    ), judged as (
        select *, n_words < {LEAST_WORDS}
            or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed
        from facts
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        base_failed, not base_failed and {_rules_sql()} as kept
    from judged
    """,
)
def op6(spark, sf_dir):
    """The documents under the quality rules."""
    return quality(table(spark, sf_dir, "documents", "doc_id", "text"))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op7_url_filters",
    f"""
    with rules(rule_host, rule_path, rule_verdict) as (values {", ".join(map(str, URL_RULES))}),
    r as (
        select page_id, case when instr(url, '://') > 0
            then substr(url, instr(url, '://') + 3) else '' end as rest
        from pages
    ), p as (
        select page_id, rest,
            translate(regexp_extract(rest, '^[^/?#]*'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
        from r
    ), m as (
        select page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
            max_by(rule_verdict, length(rule_host || rule_path)) as verdict
        from p join rules on (host = rule_host or suffix(host, '.' || rule_host))
            and starts_with(path, rule_path)
        group by page_id
    )
    select p.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
    from p left join m on p.page_id = m.page_id
    """,
)
def op7(spark, sf_dir):
    """The pages under five URL rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules)


@query("op3_toxicity")
def op3(spark, sf_dir):
    """Toxicity scores of the documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return score_texts(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query("op2_chat_formatting")
def op2(spark, sf_dir):
    """Tool calls derived from the conversations, linked with their results."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return tool_messages(*derived_traffic(turns), SCHEMAS)


#: Levels of the trees in the checking SQL: enough for 16 ** 6 leaves of a group.
_LEVELS = 6


def _leaf_sql(text):
    parts = [
        f"case when {c} is null then '-' else concat(strlen({c}::varchar), ':', {c}) end"
        for c in [*FIELDS[:-1], text]
    ]
    return f"sha256(concat({', '.join(parts)}))"


def _tree_sql(name, leaves):
    """Nodes of every level, and the children of every node in a list."""
    steps = [f"{name}0 as ({leaves})"]
    for k in range(_LEVELS):
        steps.append(
            f"{name}_run{k} as (select grp, rank // {ARITY} as rank, n,"
            f" list(digest order by rank) as kids from {name}{k} group by 1, 2, 3)"
        )
        steps.append(
            f"{name}{k + 1} as (select grp, rank, (n + {ARITY - 1}) // {ARITY} as n,"
            f" case when n = 1 then kids[1] else sha256(array_to_string(kids, '')) end as digest"
            f" from {name}_run{k})"
        )
    return steps


def _climb_sql(name, source, rank):
    """From a row's node to the root of its tree: siblings and folded digest."""
    steps = []
    for k in range(_LEVELS):
        place = f"({rank} // {ARITY**k})"
        before = f"array_to_string(r.kids[: {place} % {ARITY}], '')"
        after = f"array_to_string(r.kids[{place} % {ARITY} + 2 :], '')"
        steps.append(
            f"{name}_up{k} as (select s.* exclude (proof, folded), proof || {before} || {after} as proof,"
            f" case when r.n = 1 then folded else sha256({before} || folded || {after}) end as folded"
            f" from {source} s join {name}_run{k} r on r.rank = {place} // {ARITY}"
            f" and r.grp is not distinct from s.{name}_grp)"
        )
        source = f"{name}_up{k}"
    return steps


_CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1),
        lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda v, bit: xor(v >> 1, (v & 1) * 3988292384))))"""
_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MANIFEST_SQL = ", ".join(
    [
        f"""d as (select doc_id, source, {_leaf_sql("text")} as leaf,
            case when {_CRC_SQL} % 5 = 0 then {_leaf_sql(_LOWER_SQL)} end as other from documents),
        o as (select *, row_number() over
            (partition by source order by doc_id nulls first, leaf) - 1 as leaf_rank from d)""",
        *_tree_sql(
            "a",
            "select source as grp, leaf_rank as rank, leaf as digest, count(*) over (partition by source) as n from o",
        ),
        *_tree_sql(
            "b",
            "select null::varchar as grp, row_number() over (order by grp nulls first) - 1 as rank,"
            f" digest, count(*) over () as n from a{_LEVELS}",
        ),
        f"""g as (select row_number() over (order by grp nulls first) - 1 as top, grp, digest
            from a{_LEVELS})""",
        """s as (select o.*, o.source as a_grp, null::varchar as b_grp, g.top, g.digest as subroot,
            '' as proof, coalesce(other, leaf) as folded
            from o join g on g.grp is not distinct from o.source)""",
        *_climb_sql("a", "s", "leaf_rank"),
        *_climb_sql("b", f"a_up{_LEVELS - 1}", "top"),
    ]
)


@query(
    "op11_merkle_manifest",
    f"""
    with {_MANIFEST_SQL}
    select doc_id, leaf, subroot, b.digest as root, sha256(proof) as proof_sha256,
        folded as folded_root, folded = b.digest as verified
    from b_up{_LEVELS - 1}, b{_LEVELS} b
    """,
)
def op11(spark, sf_dir):
    """Proofs of the documents under one root, some of them tampered with."""
    return verified_manifest(table(spark, sf_dir, "documents", *FIELDS))


@query("op12_super_kmer_dedup")
def op12(spark, sf_dir):
    """Words of the documents that windows of 13 words of earlier documents cover."""
    return earlier_windows(table(spark, sf_dir, "documents", "doc_id", "text"))


def _assigned_sql(book):
    return f"""select row, part, entry, distance from (
            select row, x.part, entry, sum((x.value - b.value) * (x.value - b.value)) as distance
            from x join {book} b on x.part = b.part and x.dim = b.dim group by all)
        qualify row_number() over (partition by row, part order by distance, entry) = 1"""


_BOOKS_SQL = ", ".join(
    f"""a{k} as materialized ({_assigned_sql(f"b{k}")}),
    b{k + 1} as materialized (
        select b.part, entry, b.dim, coalesce(s.value, b.value) as value
        from b{k} b left join (
            select a.part, a.entry, x.dim, (sum(x.value) - (sum(x.value) % count(*) + count(*)) % count(*))
                // count(*) as value
            from a{k} a join x on x.row = a.row and x.part = a.part group by all
        ) s using (part, entry, dim))"""
    for k in range(ROUNDS)
)


@query(
    "op13_vector_codes",
    f"""
    with k as materialized (
        select vec_id, label, row_number() over (order by vec_id) - 1 as row,
            list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
        from embeddings where embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), x as materialized (
        select row, (i - 1) // (n // {PARTS}) as part, (i - 1) % (n // {PARTS}) as dim, value
        from (select row, len(v) as n, unnest(v) as value, unnest(range(1, len(v) + 1)) as i from k)
    ), b0 as (
        select part, row as entry, dim, value from x where row < {ENTRIES}
    ), {_BOOKS_SQL},
    f as ({_assigned_sql(f"b{ROUNDS}")}),
    c as (
        select row, string_agg(format('{{:02x}}', entry), '' order by part) as code,
            sum(distance)::bigint as error
        from f group by row
    )
    select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
        (select sha256(string_agg(value::varchar, ',' order by part, entry, dim)) from b{ROUNDS})
            as codebooks_sha256
    from k join c using (row)
    """,
)
def op13(spark, sf_dir):
    """The embeddings as codes of four entries, with their errors."""
    return vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))

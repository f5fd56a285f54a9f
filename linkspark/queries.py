"""The queries of the entity-resolution operators over the driver's tables, each with its SQL.

Documents serve as records of three sources: doc_id says which, lang is the country, the
first six words are the name and the next twelve the address. Equal texts of one
language are the true matches. The SQL fixes these 18 words; the queries named
``*_whole`` and ``gbt_matcher`` take all words from the seventh on as the address.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import similarity as S
from .functions import text as T
from .operators import blocking as B
from .operators import decision as D
from .operators import folds, longtexts, mining, report, sample, validate
from .operators import normalise as N
from .operators.competition import competition
from .operators.matcher import score, train
from .operators.pairs import labelled, native_features, pair_features, placed_pair_features
from .sources.shared import delete, fresh_dir, remove, stash
from .sources.tsv import singletons, truth_pairs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ------------------------------------------------------------------ records
BLANK = "[ \\t\\n\\r]+"


def records(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    tok = F.filter(F.split("text", BLANK), lambda x: x != "")
    rows = docs.select("doc_id", "text", "lang", tok.alias("tok"))
    part = lambda i: F.array_join(F.slice("tok", i, 3), " ")
    threes = F.transform(F.sequence(F.lit(7), F.greatest(F.size("tok"), F.lit(7)), F.lit(3)), part) if whole else F.array(*[part(i) for i in (7, 10, 13, 16)])
    addr = F.array_join(F.filter(threes, lambda x: x != ""), ", ")
    return rows.select(
        F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.array_join(F.slice("tok", 1, 6), " ").alias("business_name"), addr.alias("business_address"), F.col("lang").alias("country"), "text",
    )


RECORDS = r"""
doc AS (SELECT doc_id, text, lang, list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda x: x <> '') AS tok FROM documents),
rec AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, array_to_string(list_slice(tok, 1, 6), ' ') AS business_name,
  array_to_string(list_filter([array_to_string(list_slice(tok, 7, 9), ' '), array_to_string(list_slice(tok, 10, 12), ' '),
    array_to_string(list_slice(tok, 13, 15), ' '), array_to_string(list_slice(tok, 16, 18), ' ')], lambda x: x <> ''), ', ') AS business_address,
  lang AS country, text FROM doc)"""


@query
def scan_records(spark, sf):
    return records(spark, sf).select("entity_id", "business_name", "business_address", "country")


ORACLES["scan_records"] = f"WITH {RECORDS} SELECT entity_id, business_name, business_address, country FROM rec"


@query
def scan_whole(spark, sf):
    return records(spark, sf, whole=True).select("entity_id", "business_name", "business_address", "country")


def truth_table(spark: SparkSession, sf: str) -> DataFrame:
    """source1_entity_id, matched_entity_ids: a list for each record of the first source."""
    rows = records(spark, sf).select("entity_id", "country", F.md5("text").alias("h"))
    one = rows.filter(F.col("entity_id").startswith("S1-"))
    others = rows.filter(~F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("cand_id"), "country", "h")
    pairs = one.join(others, ["country", "h"]).select(F.col("entity_id").alias("s1_id"), "cand_id", F.lit(1).alias("p"))
    lists = D.id_lists(pairs, "p")
    return D.result_table(one.select(F.col("entity_id").alias("s1_id")), lists)


TRUTH = """
one AS (SELECT entity_id AS s1_id, country, text FROM rec WHERE entity_id LIKE 'S1-%'),
other AS (SELECT entity_id AS cand_id, country, text FROM rec WHERE entity_id NOT LIKE 'S1-%'),
truth AS (SELECT s1_id, cand_id FROM one JOIN other USING (country, text))"""


@query
def gt_explode(spark, sf):
    return truth_pairs(truth_table(spark, sf))


ORACLES["gt_explode"] = f"WITH {RECORDS}, {TRUTH} SELECT s1_id, cand_id FROM truth"


@query
def gt_singletons(spark, sf):
    return singletons(truth_table(spark, sf))


ORACLES["gt_singletons"] = f"WITH {RECORDS}, {TRUTH} SELECT s1_id FROM one WHERE s1_id NOT IN (SELECT s1_id FROM truth)"


@query
def truth_lists(spark, sf):
    return truth_table(spark, sf)


ORACLES["truth_lists"] = f"""WITH {RECORDS}, {TRUTH}
SELECT s1_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY cand_id), '') AS matched_entity_ids FROM one LEFT JOIN truth USING (s1_id) GROUP BY s1_id"""

# ------------------------------------------------------------------ folds
CRC = """
crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), range(8)),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def crc_sql(text: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


@query
def fold_split(spark, sf):
    e = F.col("entity_id")
    return records(spark, sf).select("entity_id", folds.is_val(e).alias("is_val"), folds.is_fit(e).alias("is_fit"), folds.is_stop(e).alias("is_stop"))


ORACLES["fold_split"] = f"""WITH {RECORDS}, {CRC}
SELECT entity_id, {crc_sql("entity_id")} % 5 = 0 AS is_val, {crc_sql("'fit:' || entity_id")} % 5 = 0 AS is_fit, {crc_sql("'stop:' || entity_id")} % 4 = 0 AS is_stop FROM rec, crc"""


@query
def hash_sample(spark, sf):
    return table(spark, sf, "customer").filter(folds.picked(F.col("c_name"), 0.1, "s1:")).select("c_custkey", "c_name")


ORACLES["hash_sample"] = f"WITH {CRC} SELECT c_custkey, c_name FROM customer, crc WHERE {crc_sql(chr(39) + 's1:' + chr(39) + ' || c_name')} % 1000000 < 100000"


@query
def query_modes(spark, sf):
    one = records(spark, sf).filter(F.col("entity_id").startswith("S1-")).select("entity_id")
    out = [folds.query_filter(one, m).select(F.lit(m).alias("mode"), "entity_id") for m in ("all", "val", "fit")]
    return out[0].union(out[1]).union(out[2])


ORACLES["query_modes"] = f"""WITH {RECORDS}, {CRC}, f AS (SELECT entity_id, {crc_sql("entity_id")} % 5 = 0 AS v, {crc_sql("'fit:' || entity_id")} % 5 = 0 AS f FROM rec, crc WHERE entity_id LIKE 'S1-%')
SELECT 'all' AS mode, entity_id FROM f UNION ALL SELECT 'val', entity_id FROM f WHERE v UNION ALL SELECT 'fit', entity_id FROM f WHERE v OR f"""


@query
def consistent_sample(spark, sf):
    rows = records(spark, sf).select("entity_id")
    source = lambda s: rows.filter(F.col("entity_id").startswith(f"{s}-"))
    kept = sample.sample_train(source("S1"), source("S2"), source("S3"), truth_table(spark, sf), 0.2)
    return kept["s1"].union(kept["s2"]).union(kept["s3"])


ORACLES["consistent_sample"] = f"""WITH {RECORDS}, {TRUTH}, {CRC},
k AS (SELECT s1_id FROM one, crc WHERE {crc_sql("'s1:' || s1_id")} % 1000000 < 200000)
SELECT s1_id AS entity_id FROM k UNION ALL
SELECT cand_id FROM other, crc WHERE cand_id IN (SELECT cand_id FROM truth JOIN k USING (s1_id)) OR {crc_sql("lower(substr(cand_id, 1, 2)) || cand_id")} % 1000000 < 200000"""

# ------------------------------------------------------------------ text
FOLDED = "replace(lower({0}), 'ß', 'ss')"
TOKENS = r"""list_transform(list_filter(list_transform(string_split_regex(
  replace(regexp_replace(regexp_replace(regexp_replace(translate(replace({0}, '&', ' and '), '’''', ''), '#([0-9])', '\1', 'g'), '([a-z])\.([a-z])', '\1\2', 'g'), '([a-z])\.([a-z])', '\1\2', 'g'), '.', ' '),
  '[\s,;:()\[\]{{}}<>*|"`~!?@$%^+=_\\]+'), lambda x: CASE WHEN x = '#' THEN x ELSE regexp_replace(regexp_replace(x, '^[-/#.'']+', ''), '[-/.'']+$', '') END),
  lambda x: x = '#' OR regexp_matches(x, '[^-/#]')), lambda x: strip_accents(x))"""


@query
def base_tokens(spark, sf):
    rows = records(spark, sf)
    text = T.nfkc_casefold(F.concat_ws(" ", "business_name", "business_address"))
    return rows.select("entity_id", F.array_join(T.base_tokens(text), " ").alias("tokens"))


ORACLES["base_tokens"] = f"""WITH {RECORDS}
SELECT entity_id, array_to_string({TOKENS.format(FOLDED.format("business_name || ' ' || business_address"))}, ' ') AS tokens FROM rec"""


@query
def base_components(spark, sf):
    rows = records(spark, sf)
    comps = T.components(T.nfkc_casefold(F.replace("business_address", F.lit(","), F.lit(T.COMMA))))
    return rows.select("entity_id", F.array_join(F.transform(comps, lambda c: F.array_join(c, " ")), "|").alias("comps"))


ORACLES["base_components"] = f"""WITH {RECORDS}
SELECT entity_id, array_to_string(list_filter(list_transform(string_split(business_address, ','), lambda p: array_to_string({TOKENS.format(FOLDED.format("p"))}, ' ')), lambda c: c <> ''), '|') AS comps FROM rec"""


@query
def domain_label(spark, sf):
    host = F.lower(F.regexp_extract("url", "^https?://([^/:?#]+)", 1))
    rows = table(spark, sf, "pages").select("page_id", F.regexp_replace(host, "\\.example\\.", ".").alias("host"))
    return rows.select("page_id", T.has_domain(F.col("host")).alias("is_domain"), T.name_text(F.col("host")).alias("name"))


ORACLES["domain_label"] = r"""WITH h AS (SELECT page_id, replace(lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)), '.example.', '.') AS host FROM pages)
SELECT page_id, regexp_matches(host, '\b(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:co\.in|com|net|org|in|co|io|biz|info|us|fr)\b') AS is_domain,
  replace(regexp_replace(host, '\b(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:co\.in|com|net|org|in|co|io|biz|info|us|fr)\b', '\1', 'g'), '-', ' ') AS name FROM h"""

#: Business names made of part names and, by key, what legal forms and aliases add.
NAMES = ["{0} private limited", "the {0} services co", "{0} limited liability company", "m/s {0} pvt ltd", "{0} trading as g1obal {0} group", "{0} and co dba sri {0}", "{0} c0rp", "private limited liability company"]


def business_names(spark: SparkSession, sf: str) -> DataFrame:
    name = F.lower("p_name")
    case = F.when(F.lit(False), "")
    for i, form in enumerate(NAMES):
        case = case.when(F.col("p_partkey") % len(NAMES) == i, F.replace(F.lit(form), F.lit("{0}"), name))
    return table(spark, sf, "part").select("p_partkey", name.alias("p"), F.split(case, " ").alias("name"))


@query
def clean_names(spark, sf):
    cols = N.name_columns(F.col("name"))
    return business_names(spark, sf).select("p_partkey", *[c.alias(k) for k, c in cols.items()])


# what each form of name becomes, by hand
ORACLES["clean_names"] = """WITH n AS (SELECT p_partkey, lower(p_name) AS p, p_partkey % 8 AS k FROM part)
SELECT p_partkey,
  CASE k WHEN 0 THEN p || ' pvt ltd' WHEN 1 THEN 'the ' || p || ' services co' WHEN 2 THEN p || ' llc' WHEN 3 THEN 'm/s ' || p || ' pvt ltd'
    WHEN 4 THEN p || ' global ' || p || ' group' WHEN 5 THEN p || ' and co sri ' || p WHEN 6 THEN p || ' corp' ELSE 'pvt ltd liability co' END AS name_clean,
  CASE k WHEN 4 THEN 'global ' || p WHEN 5 THEN p || ' and' WHEN 7 THEN 'liability' ELSE p END AS name_core,
  CASE k WHEN 4 THEN p || ' | global ' || p WHEN 5 THEN p || ' and | ' || p ELSE '' END AS name_alias,
  CASE k WHEN 0 THEN 'ltd pvt' WHEN 1 THEN 'co' WHEN 2 THEN 'llc' WHEN 3 THEN 'ltd pvt' WHEN 5 THEN 'co' WHEN 6 THEN 'corp' WHEN 7 THEN 'co ltd pvt' ELSE '' END AS name_legal,
  k IN (4, 5) AS f_name_alias FROM n"""


@query
def clean_addresses(spark, sf):
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    post = (500000 + F.col("c_custkey") % 1000).cast("string")
    comps = F.array(F.split(F.concat(k, F.lit("/"), n, F.lit("-b")), " "), F.array(F.concat(F.lit("00"), n), F.lower("c_mktsegment"), F.lit("road")), F.array(F.lit("near"), F.lit("bank")), F.array(F.lit("city"), post))
    return table(spark, sf, "customer").select("c_custkey", *[c.alias(name) for name, c in N.address_columns(comps).items()])


ORACLES["clean_addresses"] = """WITH a AS (SELECT c_custkey, c_custkey || '/' || c_nationkey || '-b' AS h, '00' || c_nationkey AS z, lower(c_mktsegment) || ' road' AS r, CAST(500000 + c_custkey % 1000 AS VARCHAR) AS p,
  CASE WHEN length('00' || c_nationkey) < 5 THEN CAST(c_nationkey AS VARCHAR) ELSE '00' || c_nationkey END AS n FROM customer)
SELECT c_custkey, h || ' ' || z || ' ' || r || ' city ' || p AS addr_clean, h || '|' || z || ' ' || r || '|city ' || p AS addr_comps, 'near bank' AS addr_landmark,
  h || ' ' || n AS addr_nums, CAST(c_custkey AS VARCHAR) AS addr_first_num, p AS addr_postcode FROM a"""


@query
def record_flags(spark, sf):
    n, a = F.col("business_name"), F.col("business_address")
    return records(spark, sf).select("entity_id", T.is_native(n).alias("f_name_native"), T.is_caps(n).alias("f_name_caps"), T.is_junk(n).alias("f_name_junk"), (F.trim(a) == "").alias("f_addr_empty"))


ORACLES["record_flags"] = rf"""WITH {RECORDS}
SELECT entity_id, regexp_matches(business_name, '[^\x{{0}}-\x{{24F}}\x{{1E00}}-\x{{1EFF}}\x{{2000}}-\x{{206F}}]') AS f_name_native,
  regexp_matches(business_name, '\p{{Lu}}') AND NOT regexp_matches(business_name, '[\p{{Ll}}\p{{Lt}}]') AS f_name_caps,
  regexp_matches(business_name, '^\s*[^\p{{L}}\p{{N}}_\s(\[]{{2,}}') AS f_name_junk, trim(business_address) = '' AS f_addr_empty FROM rec"""


@query
def clean_records(spark, sf):
    return N.clean(records(spark, sf).drop("text"))


@query
def clean_whole(spark, sf):
    return N.clean(records(spark, sf, whole=True).drop("text"))


@query
def clean_with_dictionary(spark, sf):
    """Cleaning with a dictionary mined from the true pairs, both in one plan."""
    rows = records(spark, sf).drop("text")
    words, _ = mining.mine(truth_pairs(truth_table(spark, sf)), rows, rows)
    return N.clean(rows, words)


# ------------------------------------------------------------------ blocking
def view(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    """Clean records of a plain kind, which SQL can follow: letters and digits, in lower case."""
    rows = records(spark, sf, whole)
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", ""), " +", " "))
    name, addr = plain("business_name"), plain("business_address")
    return rows.select("entity_id", "country", name.alias("name_core"), F.lit("").alias("name_alias"), addr.alias("addr_clean"), F.regexp_extract(addr, "[0-9]+", 0).alias("addr_first_num"), F.lit("").alias("addr_postcode"))


VIEW = r"""
v AS (SELECT entity_id AS id, country, trim(regexp_replace(regexp_replace(lower(business_name), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')) AS nc,
  trim(regexp_replace(regexp_replace(lower(business_address), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')) AS ac FROM rec),
nt AS (SELECT country, id, unnest(string_split(nc, ' ')) AS x FROM v),
adt AS (SELECT country, id, unnest(string_split(ac, ' ')) AS x FROM v),
cc AS (SELECT country, id, replace(nc, ' ', '') AS x FROM v),
feat AS (SELECT DISTINCT * FROM (
  SELECT country, id, 'n' AS grp, x AS feat FROM nt UNION ALL
  SELECT country, id, 'p', '<' || substr(x, 1, 4) FROM nt WHERE length(x) >= 5 UNION ALL SELECT country, id, 'p', '>' || right(x, 4) FROM nt WHERE length(x) >= 5 UNION ALL
  SELECT country, id, 'c', x FROM cc UNION ALL
  SELECT country, id, 'c', 'c<' || substr(x, 1, 5) FROM cc WHERE length(x) >= 7 UNION ALL SELECT country, id, 'c', 'c>' || right(x, 5) FROM cc WHERE length(x) >= 7 UNION ALL
  SELECT country, id, 'a', x FROM adt UNION ALL SELECT country, id, 'a', ltrim(x, '0') FROM adt WHERE x LIKE '0%' UNION ALL
  SELECT country, id, 'f', ltrim(regexp_extract(ac, '[0-9]+'), '0') FROM v) WHERE feat <> ''),
tf AS (SELECT * FROM feat WHERE id NOT LIKE 'S1-%'), qf AS (SELECT * FROM feat WHERE id LIKE 'S1-%'),
nn AS (SELECT country, count(*) AS n FROM v WHERE id NOT LIKE 'S1-%' GROUP BY country),
st AS (SELECT country, grp, feat, count(*) AS df, pow(ln(1 + max(n) / count(*)), 2) AS w FROM tf JOIN nn USING (country) GROUP BY ALL),
qw AS (SELECT * FROM qf JOIN st USING (country, grp, feat)), tw AS (SELECT * FROM tf JOIN st USING (country, grp, feat)),
nrm AS (SELECT country, id, sqrt(sum(CASE WHEN grp IN ('n', 'p', 'c') THEN w ELSE 0 END)) AS norm_name, sqrt(sum(CASE WHEN grp IN ('n', 'p', 'c') THEN 0 ELSE w END)) AS norm_addr
  FROM (SELECT * FROM qw UNION ALL SELECT * FROM tw) GROUP BY country, id),
pr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, id, grp IN ('n', 'p', 'c') ORDER BY df, grp, feat) AS r FROM qw WHERE df <= 10000) WHERE r <= 5),
tc AS (SELECT country, q, d, acc FROM (SELECT *, row_number() OVER (PARTITION BY country, q ORDER BY round(acc, 9) DESC, d) AS r FROM (
  SELECT pr.country, pr.id AS q, tf.id AS d, sum(pr.w) AS acc FROM pr JOIN tf ON pr.country = tf.country AND pr.grp = tf.grp AND pr.feat = tf.feat GROUP BY ALL)) WHERE r <= 3000),
sm AS (SELECT tc.country, q, d, sum(CASE WHEN qw.grp IN ('n', 'p', 'c') THEN qw.w ELSE 0 END) AS sn, sum(CASE WHEN qw.grp IN ('n', 'p', 'c') THEN 0 ELSE qw.w END) AS sa
  FROM tc JOIN qw ON qw.country = tc.country AND qw.id = tc.q JOIN tf ON tf.country = tc.country AND tf.id = tc.d AND tf.grp = qw.grp AND tf.feat = qw.feat GROUP BY ALL),
cs AS (SELECT sm.*, CASE WHEN a.norm_name * b.norm_name > 0 THEN sn / (a.norm_name * b.norm_name) ELSE 0 END AS cn, CASE WHEN a.norm_addr * b.norm_addr > 0 THEN sa / (a.norm_addr * b.norm_addr) ELSE 0 END AS ca
  FROM sm JOIN nrm a ON a.country = sm.country AND a.id = q JOIN nrm b ON b.country = sm.country AND b.id = d),
cand AS (SELECT * FROM (SELECT country, q AS s1_id, d AS cand_id, cn AS cos_name, ca AS cos_addr, cn + 1.3 * ca AS score,
  CAST(row_number() OVER (PARTITION BY country, q ORDER BY round(cn + 1.3 * ca, 9) DESC, d) - 1 AS INTEGER) AS rank FROM cs) WHERE rank < 20)"""
BLOCK = f"WITH {RECORDS}, {VIEW}"


def sides(spark: SparkSession, sf: str, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    rows = view(spark, sf, whole)
    one = F.col("entity_id").startswith("S1-")
    return rows.filter(one), rows.filter(~one)


def weighted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    q, t = sides(spark, sf)
    tf = B.features(t)
    stats = B.weights(B.document_frequency(tf), t.groupBy("country").agg(F.count("*").alias("n")))
    keys = ["country", "grp", "feat"]
    return stats, B.features(q).join(stats, keys), tf.join(stats, keys)


@query
def sparse_features(spark, sf):
    return B.features(view(spark, sf))


ORACLES["sparse_features"] = f"{BLOCK} SELECT country, id, grp, feat FROM feat"


@query
def idf_weights(spark, sf):
    return weighted(spark, sf)[0].withColumn("w", F.round("w", 6))


ORACLES["idf_weights"] = f"{BLOCK} SELECT country, grp, feat, df, round(w, 6) AS w FROM st"


@query
def record_norms(spark, sf):
    _, q, t = weighted(spark, sf)
    return B.norms(q.unionByName(t)).select("country", "id", F.round("norm_name", 6).alias("norm_name"), F.round("norm_addr", 6).alias("norm_addr"))


ORACLES["record_norms"] = f"{BLOCK} SELECT country, id, round(norm_name, 6) AS norm_name, round(norm_addr, 6) AS norm_addr FROM nrm"


@query
def rare_probe(spark, sf):
    return B.probes(weighted(spark, sf)[1]).select("country", "id", "grp", "feat", "df")


ORACLES["rare_probe"] = f"{BLOCK} SELECT country, id, grp, feat, df FROM pr"


@query
def touch_score(spark, sf):
    _, q, t = weighted(spark, sf)
    return B.touched(B.probes(q), t).select("country", "q", "d", F.round("acc", 6).alias("acc"))


ORACLES["touch_score"] = f"{BLOCK} SELECT country, q, d, round(acc, 6) AS acc FROM tc"


def candidates(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    return B.block(*sides(spark, sf, whole))


def shown(rows: DataFrame) -> DataFrame:
    return rows.select("country", "s1_id", "cand_id", F.round("cos_name", 6).alias("cos_name"), F.round("cos_addr", 6).alias("cos_addr"), F.round("score", 6).alias("score"), "rank")


@query
def block_topk(spark, sf):
    return shown(candidates(spark, sf))


@query
def block_whole(spark, sf):
    return shown(candidates(spark, sf, whole=True))


ORACLES["block_topk"] = f"{BLOCK} SELECT country, s1_id, cand_id, round(cos_name, 6) AS cos_name, round(cos_addr, 6) AS cos_addr, round(score, 6) AS score, rank FROM cand"


@query
def recall_at_k(spark, sf):
    found = B.recall(candidates(spark, sf), truth_pairs(truth_table(spark, sf)))
    return found.select("k", F.round("recall", 6).alias("recall"), F.round("recall_covered", 6).alias("recall_covered"))


ORACLES["recall_at_k"] = f"""{BLOCK}, {TRUTH}
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN rank < k THEN 1 ELSE 0 END), 6) AS recall, round(avg(CASE WHEN truth.s1_id NOT IN (SELECT s1_id FROM cand) THEN NULL WHEN rank < k THEN 1 ELSE 0 END), 6) AS recall_covered
FROM truth LEFT JOIN cand USING (s1_id, cand_id), (SELECT unnest([1, 3, 5, 10, 15, 20, 30, 40]) AS k) GROUP BY k"""

# ------------------------------------------------------------------ pairs
REAL = ["q_best", "q_gap", "q_gap_src", "q_best_name", "q_best_addr", "c_gap", "c_margin", "q_margin"]
WHOLE = ["is_s3", "q_n", "q_rank_src", "c_n", "c_rank"]


def rounded(rows: DataFrame) -> DataFrame:
    """Candidates with scores rounded, so that ranks don't hang on the last digit."""
    return rows.select("s1_id", "cand_id", *[F.round(c, 9).alias(c) for c in ("cos_name", "cos_addr", "score")], "rank")


@query
def competition_stats(spark, sf):
    rows = competition(rounded(candidates(spark, sf)))
    return rows.select("s1_id", "cand_id", *WHOLE, *[F.round(c, 6).alias(c) for c in REAL])


ORACLES["competition_stats"] = f"""{BLOCK},
r AS (SELECT s1_id, cand_id, round(cos_name, 9) AS cn, round(cos_addr, 9) AS ca, round(score, 9) AS s, CAST(cand_id LIKE 'S3-%' AS INTEGER) AS is_s3 FROM cand),
x AS (SELECT *, max(s) OVER q AS qb, max(s) OVER c AS cb, coalesce(nth_value(s, 2) OVER (PARTITION BY s1_id ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS q2,
  coalesce(nth_value(s, 2) OVER (PARTITION BY cand_id ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS c2,
  CAST(count(*) OVER q AS INTEGER) AS q_n, CAST(count(*) OVER c AS INTEGER) AS c_n, max(cn) OVER q AS qn, max(ca) OVER q AS qa, max(s) OVER (PARTITION BY s1_id, is_s3) AS sb,
  CAST(row_number() OVER (PARTITION BY s1_id, is_s3 ORDER BY s DESC, cand_id) - 1 AS INTEGER) AS q_rank_src, CAST(row_number() OVER (PARTITION BY cand_id ORDER BY s DESC, s1_id) - 1 AS INTEGER) AS c_rank
  FROM r WINDOW q AS (PARTITION BY s1_id), c AS (PARTITION BY cand_id))
SELECT s1_id, cand_id, is_s3, q_n, q_rank_src, c_n, c_rank, round(qb, 6) AS q_best, round(qb - s, 6) AS q_gap, round(sb - s, 6) AS q_gap_src, round(qn, 6) AS q_best_name, round(qa, 6) AS q_best_addr,
  round(cb - s, 6) AS c_gap, round(s - CASE WHEN s >= cb THEN c2 ELSE cb END, 6) AS c_margin, round(s - CASE WHEN s >= qb THEN q2 ELSE qb END, 6) AS q_margin FROM x"""


def full_view(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    """The plain view with all the attributes of clean records."""
    rows = view(spark, sf, whole)
    nums = F.array_join(F.array_distinct(F.regexp_extract_all("addr_clean", F.lit("[0-9]+"), F.lit(0))), " ")
    more = {"name_clean": F.col("name_core"), "name_legal": F.substring("name_core", 1, 1), "addr_comps": F.replace("addr_clean", F.lit(" "), F.lit("|")), "addr_landmark": F.lit(""), "addr_nums": nums}
    flags = {f: F.lit(False) for f in ("f_name_domain", "f_name_alias", "f_name_native", "f_addr_native", "f_name_caps", "f_addr_caps", "f_name_junk")}
    return rows.withColumns({**more, **flags, "f_addr_empty": F.col("addr_clean") == ""})


@query
def pair_sets(spark, sf):
    """Set, length and agreement features of candidate pairs."""
    from .operators.pairs import attached

    rows = full_view(spark, sf)
    pairs = native_features(attached(rounded(candidates(spark, sf)), rows, rows))
    return pairs.select("s1_id", "cand_id", "nc_equal", F.round("nc_jacc", 6).alias("nc_jacc"), "n_tok_l", "n_tok_r", "n_len_diff", "legal_agree", F.round("a_num_jacc", 6).alias("a_num_jacc"), "a_num_both", F.round("a_comp_jacc", 6).alias("a_comp_jacc"), "a_first_num", "a_len_l", "a_len_r")


JACC = "CASE WHEN {0} = '' OR {1} = '' THEN 0.0 ELSE len(list_intersect(string_split({0}, {2}), string_split({1}, {2}))) / len(list_distinct(list_concat(string_split({0}, {2}), string_split({1}, {2})))) END"
ORACLES["pair_sets"] = f"""{BLOCK},
w AS (SELECT id, nc, ac, replace(nc, ' ', '') AS k, substr(nc, 1, 1) AS lg, array_to_string(list_distinct(regexp_extract_all(ac, '[0-9]+')), ' ') AS nu, regexp_extract(ac, '[0-9]+') AS fn FROM v)
SELECT s1_id, cand_id, CAST(a.k = b.k AND a.k <> '' AS INTEGER) AS nc_equal, round({JACC.format("a.nc", "b.nc", "' '")}, 6) AS nc_jacc,
  CAST(len(list_filter(string_split(a.nc, ' '), lambda x: x <> '')) AS INTEGER) AS n_tok_l, CAST(len(list_filter(string_split(b.nc, ' '), lambda x: x <> '')) AS INTEGER) AS n_tok_r,
  CAST(abs(length(a.k) - length(b.k)) AS INTEGER) AS n_len_diff, CASE WHEN a.lg = '' OR b.lg = '' THEN 0 WHEN a.lg = b.lg THEN 1 ELSE -1 END AS legal_agree,
  round({JACC.format("a.nu", "b.nu", "' '")}, 6) AS a_num_jacc, CAST(a.nu <> '' AND b.nu <> '' AS INTEGER) AS a_num_both, round({JACC.format("a.ac", "b.ac", "' '")}, 6) AS a_comp_jacc,
  CASE WHEN a.fn = '' OR b.fn = '' THEN 0 WHEN a.fn = b.fn THEN 1 ELSE -1 END AS a_first_num, CAST(length(a.ac) AS INTEGER) AS a_len_l, CAST(length(b.ac) AS INTEGER) AS a_len_r
FROM cand JOIN w a ON a.id = s1_id JOIN w b ON b.id = cand_id"""


def part_pairs(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "part").select("p_partkey", "p_name")
    other = names.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("next"))
    return names.join(other, "p_partkey")


@query
def jaro_winkler_pairs(spark, sf):
    return part_pairs(spark, sf).select("p_partkey", F.round(S.jaro_winkler_similarity("p_name", "next"), 6).alias("jw"))


ORACLES["jaro_winkler_pairs"] = "SELECT a.p_partkey, round(jaro_winkler_similarity(a.p_name, b.p_name), 6) AS jw FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1"


@query
def ratio_pairs(spark, sf):
    measures = {"ratio": S.indel_ratio, "tset": S.token_set_ratio, "tsort": S.token_sort_ratio, "partial": S.partial_ratio, "ptset": S.partial_token_set_ratio}
    return part_pairs(spark, sf).select("p_partkey", *[f("p_name", "next").alias(k) for k, f in measures.items()])


def ratio_sql(a: str, b: str) -> str:
    """200 LCS / (|a| + |b|) in SQL, for texts of up to 126 characters: one bit of a whole number a character of a, one step of the fold a character of b."""
    full = f"((CAST(1 AS HUGEINT) << CAST(length({a}) AS INTEGER)) - 1)"
    mask = f"list_transform(string_split({b}, ''), lambda c: CAST(list_sum(list_transform(range(CAST(length({a}) AS BIGINT)), lambda i: CASE WHEN substr({a}, i + 1, 1) = c THEN CAST(1 AS HUGEINT) << CAST(i AS INTEGER) ELSE CAST(0 AS HUGEINT) END)) AS HUGEINT))"
    row = f"list_reduce(list_prepend({full}, {mask}), lambda v, u: ((v + (v & u)) | (v - (v & u))) & {full})"
    return f"(CASE WHEN {a} = '' AND {b} = '' THEN 100.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 200.0 * (length({a}) - bit_count({row})) / (length({a}) + length({b})) END)"


def words_sql(a: str) -> str:
    return f"list_filter(string_split({a}, ' '), lambda x: x <> '')"


def joined_sql(words: str) -> str:
    return f"array_to_string(list_sort({words}), ' ')"


def tsort_sql(a: str, b: str) -> str:
    return ratio_sql(joined_sql(words_sql(a)), joined_sql(words_sql(b)))


def sets_sql(a: str, b: str) -> tuple[str, str, str]:
    """The shared words of two texts, and each one's own, sorted and joined."""
    x, y = f"list_distinct({words_sql(a)})", f"list_distinct({words_sql(b)})"
    return joined_sql(f"list_intersect({x}, {y})"), joined_sql(f"list_filter({x}, lambda w: NOT list_contains({y}, w))"), joined_sql(f"list_filter({y}, lambda w: NOT list_contains({x}, w))")


def tset_sql(a: str, b: str) -> str:
    both, left, right = sets_sql(a, b)
    one, two = f"trim({both} || ' ' || {left})", f"trim({both} || ' ' || {right})"
    some = f"{both} <> ''"
    best = f"greatest({ratio_sql(one, two)}, CASE WHEN {some} THEN greatest({ratio_sql(both, one)}, {ratio_sql(both, two)}) ELSE 0 END)"
    return f"(CASE WHEN trim({a}) = '' OR trim({b}) = '' THEN 0.0 WHEN {some} AND ({left} = '' OR {right} = '') THEN 100.0 ELSE {best} END)"


def windows_sql(short: str, long: str) -> str:
    window = f"substr({long}, CAST(greatest(e - length({short}), 0) + 1 AS BIGINT), CAST(e - greatest(e - length({short}), 0) AS BIGINT))"
    fits = f"(contains({short}, right({window}, 1)) OR (e > length({long}) AND contains({short}, left({window}, 1))))"
    return f"list_max(list_transform(range(1, CAST(length({long}) + length({short}) AS BIGINT)), lambda e: CASE WHEN {fits} THEN {ratio_sql(short, window)} ELSE 0.0 END))"


def partial_sql(a: str, b: str) -> str:
    one, two = windows_sql(a, b), windows_sql(b, a)
    best = f"CASE WHEN length({a}) < length({b}) THEN {one} WHEN length({a}) > length({b}) THEN {two} ELSE greatest({one}, {two}) END"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN CASE WHEN {a} = {b} THEN 100.0 ELSE 0.0 END WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 100.0 ELSE {best} END)"


def whole_sql(value: str) -> str:
    return f"CAST(floor({value} + 0.5) AS INTEGER)"


ORACLES["ratio_pairs"] = f"""WITH p AS (SELECT a.p_partkey, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
s AS (SELECT *, {sets_sql("a", "b")[0]} AS bt, {sets_sql("a", "b")[1]} AS l, {sets_sql("a", "b")[2]} AS r FROM p)
SELECT p_partkey, {whole_sql(ratio_sql("a", "b"))} AS ratio, {whole_sql(tset_sql("a", "b"))} AS tset, {whole_sql(tsort_sql("a", "b"))} AS tsort, {whole_sql(partial_sql("a", "b"))} AS partial,
  CASE WHEN bt <> '' THEN 100 ELSE {whole_sql(partial_sql("l", "r"))} END AS ptset FROM s"""


@query
def seq_ratio_pairs(spark, sf):
    return part_pairs(spark, sf).select("p_partkey", F.round(S.seq_ratio("p_name", "next"), 6).alias("seq"))


def business_pairs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, left, right): a part's name as a business of the first source, with the next part's as one of the second; some lack a landmark, an alias or a postcode."""
    rows = part_pairs(spark, sf).withColumn("k", F.col("p_partkey"))
    odd = lambda n, a, b="": F.when(F.col("k") % n == 0, F.lit(a) if isinstance(a, str) else a).otherwise(F.lit(b) if isinstance(b, str) else b)
    flags = {f: F.lit(False) for f in ("f_name_domain", "f_name_alias", "f_name_native", "f_addr_native", "f_name_caps", "f_addr_caps", "f_name_junk", "f_addr_empty")}
    number = F.col("k").cast("string")

    def side(key: str, name: Column, legal: Column, alias: Column, addr: Column, mark: Column, nums: Column, post: Column) -> DataFrame:
        made = {"name_clean": F.concat(name, F.lit(" "), legal), "name_core": name, "name_legal": legal, "name_alias": alias, "addr_clean": addr, "addr_comps": F.replace(addr, F.lit(" "), F.lit("|")), "addr_landmark": mark, "addr_nums": nums, "addr_first_num": nums, "addr_postcode": post}
        return rows.select(F.concat(F.lit(key), number).alias("entity_id"), *[c.alias(n) for n, c in (made | flags).items()])

    left = side("S1-", F.col("p_name"), odd(2, "ltd", "llc"), F.lit(""), F.concat(number, F.lit(" main road "), F.col("p_name")), odd(3, F.concat(F.lit("near "), F.col("p_name"))), number, odd(5, "560001"))
    right = side("S2-", F.col("next"), odd(3, "ltd", "inc"), odd(4, F.concat(F.col("next"), F.lit(" | "), F.col("p_name"))), F.concat(F.lit("road "), F.col("next"), F.lit(" "), number), odd(2, F.concat(F.lit("near "), F.col("next"))), odd(7, number), odd(2, "560001", "560002"))
    pairs = rows.select(F.concat(F.lit("S1-"), number).alias("s1_id"), F.concat(F.lit("S2-"), number).alias("cand_id"), F.col("k") % 4 * 0.25 + 0.5, F.lit(0.25), F.lit(0.0), F.lit(0)).toDF("s1_id", "cand_id", "cos_name", "cos_addr", "score", "rank")
    return pairs, left, right


STRINGS = ["n_ratio", "n_tset", "nc_tsort", "nc_partial", "nc_compact_ratio", "alias_sim", "a_ratio", "a_tset", "a_partial", "lm_sim", "legal_agree", "a_postcode", "a_first_num", "a_num_both", "nc_equal", "n_tok_l", "n_tok_r", "r_f_name_caps", "l_addr_empty", "is_s3", "c_n", "q_n"]


@query
def pair_strings(spark, sf):
    """The matcher's inputs of pairs with aliases, landmarks and postcodes."""
    rows = pair_features(*business_pairs(spark, sf))
    return rows.select("s1_id", "cand_id", *STRINGS, F.round("nc_jw", 6).alias("nc_jw"))


ORACLES["pair_strings"] = f"""WITH p AS (SELECT a.p_partkey AS k, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
c AS (SELECT *, a || CASE WHEN k % 2 = 0 THEN ' ltd' ELSE ' llc' END AS na, b || CASE WHEN k % 3 = 0 THEN ' ltd' ELSE ' inc' END AS nb, replace(a, ' ', '') AS ca, replace(b, ' ', '') AS cb,
  CASE WHEN k % 4 = 0 THEN b || ' | ' || a ELSE '' END AS al, k || ' main road ' || a AS aa, 'road ' || b || ' ' || k AS ab, CASE WHEN k % 3 = 0 THEN 'near ' || a ELSE '' END AS la, CASE WHEN k % 2 = 0 THEN 'near ' || b ELSE '' END AS lb FROM p)
SELECT 'S1-' || k AS s1_id, 'S2-' || k AS cand_id, {whole_sql(ratio_sql("na", "nb"))} AS n_ratio, {whole_sql(tset_sql("na", "nb"))} AS n_tset, {whole_sql(tsort_sql("a", "b"))} AS nc_tsort,
  {whole_sql(partial_sql("a", "b"))} AS nc_partial, {whole_sql(ratio_sql("ca", "cb"))} AS nc_compact_ratio, CASE WHEN al = '' THEN 0 ELSE {whole_sql(tsort_sql("a", "al"))} END AS alias_sim,
  {whole_sql(ratio_sql("aa", "ab"))} AS a_ratio, {whole_sql(tset_sql("aa", "ab"))} AS a_tset, 100 AS a_partial, CASE WHEN la = '' OR lb = '' THEN 255 ELSE {whole_sql(tset_sql("la", "lb"))} END AS lm_sim,
  CASE WHEN (k % 2 = 0) = (k % 3 = 0) AND k % 2 = 0 THEN 1 ELSE -1 END AS legal_agree, CASE WHEN k % 5 <> 0 THEN 0 WHEN k % 2 = 0 THEN 1 ELSE -1 END AS a_postcode,
  CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS a_first_num, CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS a_num_both, CASE WHEN ca = cb THEN 1 ELSE 0 END AS nc_equal,
  CAST(len(string_split(a, ' ')) AS INTEGER) AS n_tok_l, CAST(len(string_split(b, ' ')) AS INTEGER) AS n_tok_r, 0 AS r_f_name_caps, 0 AS l_addr_empty, 0 AS is_s3, 1 AS c_n, 1 AS q_n,
  round(jaro_winkler_similarity(ca, cb), 6) AS nc_jw FROM c"""

def business_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The records of business_pairs(), the brand as their country."""
    brand = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("_k"), F.col("p_brand").alias("country"))
    of = lambda rows: rows.join(brand, F.substring_index("entity_id", "-", -1) == F.col("_k")).drop("_k")
    _, left, right = business_pairs(spark, sf)
    return of(left), of(right)


BUSINESS = """WITH p AS (SELECT a.p_partkey AS k, a.p_brand AS country, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
v AS (SELECT 'S1-' || k AS id, country, a AS nc, '' AS al, k || ' main road ' || a AS ac, CAST(k AS VARCHAR) AS fn, CASE WHEN k % 5 = 0 THEN '560001' ELSE '' END AS pc FROM p UNION ALL
  SELECT 'S2-' || k, country, b, CASE WHEN k % 4 = 0 THEN b || ' | ' || a ELSE '' END, 'road ' || b || ' ' || k, CASE WHEN k % 7 = 0 THEN CAST(k AS VARCHAR) ELSE '' END, CASE WHEN k % 2 = 0 THEN '560001' ELSE '560002' END FROM p),
nt AS (SELECT country, id, unnest(list_filter(list_concat(string_split(nc, ' '), string_split(al, ' ')), lambda x: x <> '|')) AS x FROM v),
adt AS (SELECT country, id, unnest(string_split(ac, ' ')) AS x FROM v), cc AS (SELECT country, id, replace(nc, ' ', '') AS x FROM v),
""" + VIEW[VIEW.index("feat AS") : VIEW.index("SELECT country, id, 'f'")] + "SELECT country, id, 'f', ltrim(fn, '0') FROM v UNION ALL SELECT country, id, 'z', pc FROM v) WHERE feat <> ''),\n" + VIEW[VIEW.index("tf AS") :]


@query
def business_features(spark, sf):
    """Features of all six groups: aliases and postcodes too."""
    left, right = business_sides(spark, sf)
    return B.features(left.unionByName(right))


ORACLES["business_features"] = f"{BUSINESS} SELECT country, id, grp, feat FROM feat"


@query
def block_business(spark, sf):
    return shown(B.block(*business_sides(spark, sf)))


ORACLES["block_business"] = f"{BUSINESS} SELECT country, s1_id, cand_id, round(cos_name, 6) AS cos_name, round(cos_addr, 6) AS cos_addr, round(score, 6) AS score, rank FROM cand"

#: A mined dictionary of all kinds: own maps of two countries, and what is pooled for the others.
RULES = [
    ("name", "india", "servcies", "services"), ("name", "india", "pvtt", "pvt"), ("name", "_all", "servcies", "srv"), ("name", "_all", "intl", "international"), ("name", "_all", "trdg", "trading"), ("name", "_all", "शक्ति", "shakti"),
    ("addr", "_all", "rd", "road"), ("addr", "_all", "mn", "main"), ("addr", "us", "mn", "minnesota"), ("comp", "_all", "blr", "bengaluru city"),
]


@query
def dictionary_rules(spark, sf):
    """Cleaning with a dictionary of own and pooled maps, whole components, values of several words and address words by hand."""
    k = F.col("c_custkey")
    of = lambda n, *forms: F.get(F.array(*[F.lit(x) for x in forms]), (k % n).cast("int"))
    name = F.replace(of(4, "Delta{} Servcies Pvtt Ltd", "Nova शक्ति Ltd", "Acme{} Intl Inc", "Royal{} Trdg Co"), F.lit("{}"), k.cast("string"))
    rows = table(spark, sf, "customer").select(
        F.concat(F.lit("S2-"), k).alias("entity_id"), name.alias("business_name"), F.concat(k, F.lit(" Mn Rd, Blr, R de Oak")).alias("business_address"), of(3, "India", "US", " france ").alias("country")
    )
    words = spark.createDataFrame(RULES, "kind string, country string, noisy string, canon string")
    return N.clean(rows, words).select("entity_id", "country", "name_clean", "name_legal", "addr_clean", "addr_comps", "addr_nums", "f_name_native", "f_addr_native")


ORACLES["dictionary_rules"] = """WITH c AS (SELECT c_custkey AS k, c_custkey % 4 AS n, c_custkey % 3 AS c FROM customer),
a AS (SELECT *, k || CASE c WHEN 1 THEN ' minnesota rd' ELSE ' main road' END AS street, CASE c WHEN 2 THEN 'rue' ELSE 'r' END || ' de oak' AS oak FROM c)
SELECT 'S2-' || k AS entity_id, CASE c WHEN 0 THEN 'India' WHEN 1 THEN 'US' ELSE ' france ' END AS country,
  CASE WHEN n = 0 THEN 'delta' || k || CASE c WHEN 0 THEN ' services pvt ltd' ELSE ' srv pvtt ltd' END WHEN n = 1 THEN 'nova shakti ltd'
    WHEN n = 2 THEN 'acme' || k || CASE c WHEN 0 THEN ' intl inc' ELSE ' international inc' END ELSE 'royal' || k || CASE c WHEN 0 THEN ' trdg co' ELSE ' trading co' END END AS name_clean,
  CASE WHEN n = 0 AND c = 0 THEN 'ltd pvt' WHEN n < 2 THEN 'ltd' WHEN n = 2 THEN 'inc' ELSE 'co' END AS name_legal,
  street || ' bengaluru city ' || oak AS addr_clean, street || '|bengaluru city|' || oak AS addr_comps, CAST(k AS VARCHAR) AS addr_nums, n = 1 AS f_name_native, false AS f_addr_native FROM a"""


@query
def ngram_jaccard(spark, sf):
    rows = part_pairs(spark, sf).select("p_partkey", T.ngrams(F.col("p_name")).alias("a"), T.ngrams(F.col("next")).alias("b"))
    return rows.select("p_partkey", F.round(F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b")), 6).alias("jacc"))


ORACLES["ngram_jaccard"] = """WITH g AS (SELECT p_partkey, list_distinct(list_transform(range(1, greatest(length(p_name) - 1, 2)), lambda i: substr(p_name, i, 3))) AS g FROM part)
SELECT a.p_partkey, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 6) AS jacc FROM g a JOIN g b ON b.p_partkey = a.p_partkey + 1"""


@query
def subsequence_pairs(spark, sf):
    short = F.concat(F.substring("p_name", 1, 1), F.substring("p_name", 4, 1), F.substring("next", 2, 1))
    return part_pairs(spark, sf).select("p_partkey", S.is_subsequence(short, F.col("p_name")).alias("sub"))


ORACLES["subsequence_pairs"] = """SELECT a.p_partkey, regexp_matches(a.p_name, substr(a.p_name, 1, 1) || '.*' || substr(a.p_name, 4, 1) || '.*' || substr(b.p_name, 2, 1)) AS sub
FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1"""


@query
def pair_features_all(spark, sf):
    rows = full_view(spark, sf)
    return pair_features(rounded(candidates(spark, sf)), rows, rows)


# ------------------------------------------------------------------ mining
def noisy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Part names and noisy copies: a word abbreviated, one inserted, or two exchanged, by key."""
    k, n = F.col("p_partkey") % 3, F.lower("p_name")
    noisy = F.when(k == 0, F.regexp_replace(n, "([a-z]{4})[a-z]+$", "$1")).when(k == 1, F.concat(n, F.lit(" services"))).otherwise(F.regexp_replace(n, "^(\\S+) (\\S+)", "$2 $1"))
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("pair"), F.lower("p_brand").alias("country"), n.alias("a"), noisy.alias("b"))


def noisy_tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = noisy_pairs(spark, sf)
    both = F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("a").alias("t")), F.struct(F.lit(2).alias("side"), F.col("b").alias("t"))))
    return rows.select("pair", "country", F.lit("name").alias("kind"), both.alias("x")).select("pair", "country", "kind", "x.side", F.posexplode(F.split("x.t", " ")).alias("pos", "tok"))


MINE = r"""
np AS (SELECT CAST(p_partkey AS VARCHAR) AS pair, lower(p_brand) AS country, lower(p_name) AS a, CASE p_partkey % 3 WHEN 0 THEN regexp_replace(lower(p_name), '([a-z]{4})[a-z]+$', '\1')
  WHEN 1 THEN lower(p_name) || ' services' ELSE regexp_replace(lower(p_name), '^([^ ]+) ([^ ]+)', '\2 \1') END AS b FROM part),
ta AS (SELECT pair, country, t, p, row_number() OVER (PARTITION BY pair, t ORDER BY p) AS o FROM (SELECT pair, country, unnest(string_split(a, ' ')) AS t, unnest(range(len(string_split(a, ' ')))) AS p FROM np)),
tb AS (SELECT pair, country, t, p, row_number() OVER (PARTITION BY pair, t ORDER BY p) AS o FROM (SELECT pair, country, unnest(string_split(b, ' ')) AS t, unnest(range(len(string_split(b, ' ')))) AS p FROM np)),
eq AS (SELECT tb.country, tb.t AS noisy, tb.t AS canon FROM tb JOIN ta USING (pair, t, o)),
ra AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY p) AS i, count(*) OVER (PARTITION BY pair) AS n FROM ta ANTI JOIN tb USING (pair, t, o)),
rb AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY p) AS i, count(*) OVER (PARTITION BY pair) AS n FROM tb ANTI JOIN ta USING (pair, t, o)),
vote AS (SELECT * FROM eq UNION ALL SELECT rb.country, rb.t, ra.t FROM rb JOIN ra USING (pair, i, n) WHERE n <= 6),
cnt AS (SELECT country, noisy, canon, count(*) AS n FROM vote GROUP BY ALL UNION ALL SELECT '_all', noisy, canon, count(*) FROM vote GROUP BY noisy, canon)"""


@query
def mine_votes(spark, sf):
    votes, _ = mining.aligned(noisy_tokens(spark, sf))
    return mining.vote_counts(votes).select("country", "noisy", "canon", "n", "total")


ORACLES["mine_votes"] = f"WITH {MINE} SELECT country, noisy, canon, n, CAST(sum(n) OVER (PARTITION BY country, noisy) AS BIGINT) AS total FROM cnt"


@query
def insertion_stats(spark, sf):
    return mining.aligned(noisy_tokens(spark, sf))[1]


ORACLES["insertion_stats"] = f"""WITH {MINE}
SELECT CASE WHEN p = (SELECT min(p) FROM tb x WHERE x.pair = rb.pair) THEN 'first' WHEN p = (SELECT max(p) FROM tb x WHERE x.pair = rb.pair) THEN 'last' ELSE 'mid' END AS place, t AS tok, count(*) AS n
FROM rb WHERE n = 1 AND pair NOT IN (SELECT pair FROM ra) GROUP BY ALL"""


@query
def mine_dictionary(spark, sf):
    votes, _ = mining.aligned(noisy_tokens(spark, sf))
    return mining.dictionary(mining.vote_counts(votes))


ORACLES["mine_dictionary"] = f"""WITH {MINE}, g AS (SELECT *, sum(n) OVER (PARTITION BY country, noisy) AS total FROM cnt)
SELECT 'name' AS kind, country, noisy, canon FROM g WHERE noisy <> canon AND n >= 3 AND n >= 0.5 * total AND (contains(canon, noisy) OR contains(noisy, canon))
QUALIFY row_number() OVER (PARTITION BY country, noisy ORDER BY n DESC, canon) = 1"""


@query
def dictionary_coverage(spark, sf):
    """Words outside ASCII, and the share of them that the more frequent words of their country cover."""
    rows = records(spark, sf).select("country", F.explode(F.split(F.lower("text"), BLANK)).alias("tok"))
    words = rows.groupBy("country", "tok").agg(F.count("*").alias("n")).filter("n >= 20").select("country", F.col("tok").alias("noisy"))
    return report.dictionary_coverage(rows, words).withColumn("covered", F.round("covered", 6))


ORACLES["dictionary_coverage"] = rf"""WITH {RECORDS}, w AS (SELECT country, unnest(string_split_regex(lower(text), '[ \t\n\r]+')) AS tok FROM rec), c AS (SELECT country, tok, count(*) AS n FROM w GROUP BY ALL)
SELECT country, CAST(sum(n) AS BIGINT) AS n, round(sum(CASE WHEN n >= 20 THEN n ELSE 0 END) / sum(n), 6) AS covered FROM c WHERE regexp_matches(tok, '[^\x00-\x7f]') GROUP BY country"""


# ------------------------------------------------------------------ decisions
def probabilities(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf).select("s1_id", "cand_id", F.round(F.col("score") / 2.3, 9).alias("prob"))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return records(spark, sf).filter(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("s1_id"))


PROB = f"{BLOCK}, {TRUTH}, pb AS (SELECT s1_id, cand_id, round(score / 2.3, 9) AS prob, row_number() OVER (PARTITION BY cand_id ORDER BY round(score / 2.3, 9) DESC, s1_id) = 1 AS best FROM cand)"


@query
def assign_best(spark, sf):
    return D.assign_best(probabilities(spark, sf)).select("s1_id", "cand_id", "best")


ORACLES["assign_best"] = f"{PROB} SELECT s1_id, cand_id, best FROM pb"
GRID_SQL = """, t AS (SELECT DISTINCT s1_id, cand_id, 1 AS ok FROM truth), n AS (SELECT s1_id, count(*) AS n FROM t GROUP BY s1_id),
g AS (SELECT a AS assign, g / 100 AS threshold FROM (SELECT unnest([0, 1]) AS a), (SELECT unnest(range(30, 100, 5)) AS g)),
h AS (SELECT assign, threshold, s1_id, count(*) AS p, count(ok) AS k FROM pb LEFT JOIN t USING (s1_id, cand_id), g WHERE prob >= threshold AND (assign = 0 OR best) GROUP BY ALL),
e AS (SELECT assign, threshold, s1_id, coalesce(n, 0) AS n, coalesce(p, 0) AS p, coalesce(k, 0) AS k FROM one CROSS JOIN g LEFT JOIN n USING (s1_id) LEFT JOIN h USING (assign, threshold, s1_id)),
f AS (SELECT assign, threshold, CASE WHEN k > 0 THEN 1.25 * (k / p) * (k / n) / (0.25 * (k / p) + k / n) WHEN n = 0 AND p = 0 THEN 1 ELSE 0 END AS f FROM e),
grid AS (SELECT CAST(assign AS INTEGER) AS assign, threshold, round(avg(f), 6) AS f05 FROM f GROUP BY ALL)"""


@query
def threshold_grid(spark, sf):
    return D.threshold_grid(entities(spark, sf), truth_pairs(truth_table(spark, sf)), probabilities(spark, sf)).withColumn("f05", F.round("f05", 6))


ORACLES["threshold_grid"] = f"{PROB}{GRID_SQL} SELECT assign, threshold, f05 FROM grid"


@query
def decision_rule(spark, sf):
    return D.best_rule(threshold_grid(spark, sf))


ORACLES["decision_rule"] = f"{PROB}{GRID_SQL} SELECT assign, threshold, f05 FROM grid ORDER BY f05 DESC, assign, threshold LIMIT 1"


@query
def macro_f05(spark, sf):
    taken = D.decide(probabilities(spark, sf), True, 0.6)
    return D.macro_f05(entities(spark, sf), truth_pairs(truth_table(spark, sf)), taken).withColumn("f05", F.round("f05", 6))


ORACLES["macro_f05"] = f"{PROB}{GRID_SQL} SELECT f05, (SELECT count(*) FROM one) AS entities FROM grid WHERE assign = 1 AND threshold = 0.6"


@query
def blocking_ceiling(spark, sf):
    return D.ceiling(entities(spark, sf), truth_pairs(truth_table(spark, sf)), candidates(spark, sf)).withColumn("f05", F.round("f05", 6))


ORACLES["blocking_ceiling"] = f"""{PROB}, n AS (SELECT s1_id, count(*) AS n FROM truth GROUP BY s1_id), k AS (SELECT s1_id, count(*) AS k FROM truth JOIN cand USING (s1_id, cand_id) GROUP BY s1_id)
SELECT round(avg(CASE WHEN k > 0 THEN 1.25 * (k / n) / (0.25 + k / n) WHEN n IS NULL THEN 1 ELSE 0 END), 6) AS f05, count(*) AS entities FROM one LEFT JOIN n USING (s1_id) LEFT JOIN k USING (s1_id)"""


@query
def result_table(spark, sf):
    taken = D.decide(probabilities(spark, sf), True, 0.6)
    return D.result_table(entities(spark, sf), D.id_lists(taken, "prob"))


ORACLES["result_table"] = f"""{PROB} SELECT s1_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY prob DESC, cand_id), '') AS matched_entity_ids
FROM one LEFT JOIN (SELECT * FROM pb WHERE best AND prob >= 0.6) USING (s1_id) GROUP BY s1_id"""


@query
def candidate_lists(spark, sf):
    return D.result_table(entities(spark, sf), D.id_lists(probabilities(spark, sf), "prob"), "candidate_entity_ids")


ORACLES["candidate_lists"] = f"{PROB} SELECT s1_id AS source1_entity_id, coalesce(string_agg(cand_id, ',' ORDER BY prob DESC, cand_id), '') AS candidate_entity_ids FROM one LEFT JOIN pb USING (s1_id) GROUP BY s1_id"


@query
def validate_rules(spark, sf):
    """Findings on lines with faults of every kind, made of the customers."""
    k = F.col("c_custkey")
    rest = (F.when(k % 7 == 1, F.concat(F.lit("S2-"), k, F.lit(",S2-"), k)).when(k % 7 == 2, F.concat(F.lit("S1-"), k)).when(k % 7 == 3, F.concat(F.lit("X-"), k))
        .when(k % 7 == 4, F.lit("")).otherwise(F.concat(F.lit("S3-"), k, F.lit(",S2-"), k)))
    tab = F.when(k % 11 == 0, " ").otherwise("\t")
    lines = table(spark, sf, "customer").select(F.concat(F.lit("S1-"), F.when(k % 13 == 0, k - 1).otherwise(k), tab, rest).alias("value"))
    required = table(spark, sf, "customer").filter(k % 17 != 0).select(F.concat(F.lit("S1-"), k).alias("s1_id"))
    return validate.findings(validate.parsed(lines), required, "rows").select("rule", "n", F.array_join("examples", ",").alias("examples"))


ORACLES["validate_rules"] = """WITH l AS (SELECT c_custkey AS k, 'S1-' || CASE WHEN c_custkey % 13 = 0 THEN c_custkey - 1 ELSE c_custkey END AS s1, c_custkey % 11 <> 0 AS tab,
  CASE c_custkey % 7 WHEN 1 THEN 'S2-' || c_custkey || ',S2-' || c_custkey WHEN 2 THEN 'S1-' || c_custkey WHEN 3 THEN 'X-' || c_custkey WHEN 4 THEN '' ELSE 'S3-' || c_custkey || ',S2-' || c_custkey END AS rest FROM customer),
g AS (SELECT * FROM l WHERE tab), q AS (SELECT 'S1-' || c_custkey AS s1 FROM customer WHERE c_custkey % 17 <> 0),
b AS (SELECT DISTINCT * FROM (SELECT 'malformed' AS rule, s1 || ' ' || rest AS x FROM l WHERE NOT tab
  UNION ALL SELECT 'duplicate_row', s1 FROM g GROUP BY s1 HAVING count(*) > 1 UNION ALL SELECT 'repeated_id', s1 FROM g WHERE k % 7 = 1 UNION ALL SELECT 'self_match', rest FROM g WHERE k % 7 = 2
  UNION ALL SELECT 'wrong_prefix', rest FROM g WHERE k % 7 = 3 UNION ALL SELECT 'missing', s1 FROM q ANTI JOIN g USING (s1) UNION ALL SELECT 'extra', s1 FROM g ANTI JOIN q USING (s1)))
SELECT rule, count(*) AS n, array_to_string(list_slice(list_sort(list(x)), 1, 5), ',') AS examples FROM b GROUP BY rule"""


#: Pairs of whole texts that a task measures.
PAIRS = 4096


@query
def gbt_matcher(spark, sf):
    """Trees fitted on the candidates of the plain view of whole texts, and their scores."""
    from .sources.tsv import write_stage

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    found = candidates(spark, sf, whole=True)
    texts = fresh_dir(spark, "texts")
    rows = stash(longtexts.put(full_view(spark, sf, whole=True), texts), "records")
    one = F.col("entity_id").startswith("S1-")
    tasks = max(spark.sparkContext.defaultParallelism, min(found.count() // PAIRS + 1, B.TASKS))
    pairs = placed_pair_features(labelled(rounded(found), truth_pairs(truth_table(spark, sf))), rows.filter(one), rows.filter(~one), texts, tasks, also=("label",))
    pairs = write_stage(pairs, f"{base.rstrip('/')}/linkspark-pairs-{uuid.uuid4().hex}")
    delete(found)
    delete(rows)
    remove(spark, texts)
    return score(train(pairs, rounds=10, depth=4), pairs).withColumn("prob", F.round("prob", 6))


# ------------------------------------------------------------------ reports
@query
def field_stats(spark, sf):
    rows = report.field_stats(records(spark, sf), ["business_name", "business_address", "country"], "country")
    return rows.select("country", "field", "n", *[F.round(c, 6).alias(c) for c in ("empty_pct", "mean_len", "mean_tokens")])


ORACLES["field_stats"] = f"""WITH {RECORDS}, x AS (SELECT country, unnest(['business_name', 'business_address', 'country']) AS field, unnest([business_name, business_address, country]) AS v FROM rec)
SELECT country, field, count(*) AS n, round(100 * avg(CAST(v = '' AS INTEGER)), 6) AS empty_pct, round(avg(length(v)), 6) AS mean_len,
  round(avg(len(list_filter(string_split_regex(v, '[ \\t\\n\\r]+'), lambda t: t <> ''))), 6) AS mean_tokens FROM x GROUP BY ALL"""


@query
def value_counts(spark, sf):
    return report.value_counts(table(spark, sf, "conversations"), "role", "turn").withColumn("share", F.round("share", 9))


ORACLES["value_counts"] = "SELECT role, turn, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM conversations GROUP BY role, turn"


@query
def top_tokens(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("tok"))
    return report.top_values(words, "tok", 40)


ORACLES["top_tokens"] = "SELECT tok, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS tok FROM documents) GROUP BY tok ORDER BY n DESC, tok LIMIT 40"
PATTERNS = {"digit": "[0-9]", "email": "[a-z0-9.]+@[a-z0-9.]+", "capital": "^[A-Z]", "symbols": "[#$%&*]{2,}", "ascii": "^[\\x00-\\x7f]*$"}


@query
def pattern_share(spark, sf):
    return report.pattern_share(table(spark, sf, "documents"), "text", PATTERNS).withColumn("pct", F.round("pct", 6))


ORACLES["pattern_share"] = " UNION ALL ".join(f"SELECT '{k}' AS pattern, round(100 * avg(CAST(regexp_matches(text, '{v}') AS INTEGER)), 6) AS pct FROM documents" for k, v in PATTERNS.items())


@query
def length_hist(spark, sf):
    return report.histogram(table(spark, sf, "documents"), F.length("text"), 0, 20_000, 20, "lang")


ORACLES["length_hist"] = "SELECT lang, CAST(least(21, floor(length(text) / 1000.0) + 1) AS BIGINT) AS bucket, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY ALL"


@query
def block_sizes(spark, sf):
    return report.block_sizes(records(spark, sf), F.lower(F.substring("business_name", 1, 4)), "country").withColumns({"p50": F.round("p50", 6), "p99": F.round("p99", 6)})


ORACLES["block_sizes"] = f"""WITH {RECORDS}, b AS (SELECT country, lower(substr(business_name, 1, 4)) AS k, count(*) AS n FROM rec GROUP BY ALL)
SELECT country, count(*) AS blocks, round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS largest FROM b GROUP BY country"""


@query
def script_pivot(spark, sf):
    rows = records(spark, sf).withColumn("src", F.substring("entity_id", 1, 2))
    found = report.script_pivot(rows, "text", "country", "src", ["S1", "S2", "S3"])
    return found.select("country", "script", *[F.round(s, 6).alias(s.lower()) for s in ("S1", "S2", "S3")])


ORACLES["script_pivot"] = rf"""WITH {RECORDS}, r AS (SELECT country, substr(entity_id, 1, 2) AS s, regexp_matches(text, '[À-ÖØ-öø-ÿĀ-ɏ]') AS hit FROM rec)
SELECT country, 'Latin' AS script, round(coalesce(avg(CAST(hit AS INTEGER)) FILTER (s = 'S1'), 0), 6) AS s1, round(coalesce(avg(CAST(hit AS INTEGER)) FILTER (s = 'S2'), 0), 6) AS s2, round(coalesce(avg(CAST(hit AS INTEGER)) FILTER (s = 'S3'), 0), 6) AS s3
FROM r GROUP BY country HAVING bool_or(hit)"""


@query
def key_recall(spark, sf):
    rows = records(spark, sf).select("entity_id", "business_name", "business_address")
    side = lambda n, key: rows.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"n{n}"), F.col("business_address").alias(f"a{n}"))
    pairs = candidates(spark, sf).select("s1_id", "cand_id").join(side(1, "s1_id"), "s1_id").join(side(2, "cand_id"), "cand_id")
    keys = {"first": (report.first_word(F.col("n1")), report.first_word(F.col("n2"))), "longest": (report.longest_word(F.col("n1")), report.longest_word(F.col("n2"))), "prefix": (F.substring("n1", 1, 4), F.substring("n2", 1, 4))}
    return report.key_recall(pairs, keys).withColumn("recall", F.round("recall", 6))


ORACLES["key_recall"] = rf"""{BLOCK}, w AS (SELECT entity_id AS id, business_name AS n, list_filter(string_split_regex(lower(business_name), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ('the', 'sri', 'shri', 'dr', 'm', 's', 'mr', 'smt')) AS t FROM rec),
k AS (SELECT id, substr(n, 1, 4) AS p, coalesce(t[1], '') AS f, coalesce(list_filter(t, lambda x: length(x) = list_max(list_transform(t, lambda y: length(y))))[1], '') AS l FROM w),
h AS (SELECT a.f = b.f AND a.f <> '' AS f, a.l = b.l AND a.l <> '' AS l, a.p = b.p AND a.p <> '' AS p FROM cand JOIN k a ON a.id = s1_id JOIN k b ON b.id = cand_id)
SELECT unnest(['first', 'longest', 'prefix', 'any']) AS key, unnest([round(avg(CAST(f AS INTEGER)), 6), round(avg(CAST(l AS INTEGER)), 6), round(avg(CAST(p AS INTEGER)), 6), round(avg(CAST(f OR l OR p AS INTEGER)), 6)]) AS recall FROM h"""


@query
def address_parts(spark, sf):
    """Components of an address, the last of them, the house number and the last word of the name."""
    a = F.col("business_address")
    return records(spark, sf).select("entity_id", T.component_count(a).alias("parts"), T.last_component(a).alias("last_part"), T.house_number(a).alias("house"), T.last_word(F.col("business_name")).alias("last_word"))


ORACLES["address_parts"] = rf"""WITH {RECORDS}
SELECT entity_id, CAST(length(business_address) - length(replace(business_address, ',', '')) + 1 AS INTEGER) AS parts, trim(string_split(business_address, ',')[-1]) AS last_part,
  regexp_extract(business_address, '[0-9]+') AS house, lower(string_split(business_name, ' ')[-1]) AS last_word FROM rec"""


@query
def key_checks(spark, sf):
    rows = records(spark, sf).filter(F.col("entity_id").startswith("S1-"))
    truth = truth_table(spark, sf)
    return report.key_checks(rows, truth.filter("source1_entity_id NOT LIKE '%7'"), truth_pairs(truth))


ORACLES["key_checks"] = f"""WITH {RECORDS}, {TRUTH} SELECT 'repeated_ids' AS "check", count(*) AS n FROM (SELECT s1_id FROM one GROUP BY s1_id HAVING count(*) > 1) UNION ALL
SELECT 'no_truth', count(*) FROM one WHERE s1_id LIKE '%7' UNION ALL SELECT 'no_reference', 0 UNION ALL SELECT 'linked_twice', count(*) FROM (SELECT cand_id FROM truth GROUP BY cand_id HAVING count(DISTINCT s1_id) > 1)"""


@query
def match_counts(spark, sf):
    """Matches an entity: size, share of singletons and mean by country."""
    n = truth_table(spark, sf).select(F.col("source1_entity_id").alias("entity_id"), F.size(F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")).alias("n"))
    rows = records(spark, sf).join(n, "entity_id")
    return rows.groupBy("country").agg(F.count("*").alias("entities"), F.round(F.avg((F.col("n") == 0).cast("int")), 6).alias("singletons"), F.round(F.avg("n"), 6).alias("mean"))


ORACLES["match_counts"] = f"""WITH {RECORDS}, {TRUTH}, n AS (SELECT one.s1_id, any_value(one.country) AS country, count(cand_id) AS n FROM one LEFT JOIN truth USING (s1_id) GROUP BY one.s1_id)
SELECT country, count(*) AS entities, round(avg(CAST(n = 0 AS INTEGER)), 6) AS singletons, round(avg(n), 6) AS mean FROM n GROUP BY country"""


@query
def random_negatives(spark, sf):
    rows = records(spark, sf).select("entity_id", "country")
    one = F.col("entity_id").startswith("S1-")
    return report.random_negatives(rows.filter(one), rows.filter(~one))


ORACLES["random_negatives"] = f"""WITH {RECORDS}, {CRC},
a AS (SELECT country, entity_id AS s1_id, row_number() OVER (PARTITION BY country ORDER BY {crc_sql("'0:s1_id:' || entity_id")}, entity_id) AS rn FROM rec, crc WHERE entity_id LIKE 'S1-%'),
b AS (SELECT country, entity_id AS cand_id, row_number() OVER (PARTITION BY country ORDER BY {crc_sql("'0:cand_id:' || entity_id")}, entity_id) AS rn FROM rec, crc WHERE entity_id NOT LIKE 'S1-%')
SELECT country, s1_id, cand_id FROM a JOIN b USING (country, rn)"""


def label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """True and random pairs of clean records with the report's measures."""
    rows = N.clean(records(spark, sf).drop("text"))
    true = truth_pairs(truth_table(spark, sf)).withColumn("label", F.lit(1))
    pairs = true.unionByName(random_negatives(spark, sf).select("s1_id", "cand_id").withColumn("label", F.lit(0)))
    return report.measured(pairs, rows, rows)


@query
def similarity_by_label(spark, sf):
    """Raw and clean similarities of true and random pairs, overall and by country, source and script."""
    found = report.cleaning_report(label_pairs(spark, sf))
    return found.select("label", "country", "source", "native", "n", *[F.round(c, 6).alias(c) for c in report.MEASURES])


@query
def worst_pairs(spark, sf):
    """The true pairs of parts and noisy copies that are least alike."""
    rows = noisy_pairs(spark, sf).select(F.col("pair").alias("s1_id"), F.col("pair").alias("cand_id"), F.lit(1).alias("label"), S.indel_ratio("a", "b").alias("ratio"))
    return report.worst_pairs(rows, "ratio", 25).select("s1_id", "ratio")


ORACLES["worst_pairs"] = f"WITH {MINE} SELECT pair AS s1_id, {whole_sql(ratio_sql('a', 'b'))} AS ratio FROM np ORDER BY ratio, pair LIMIT 25"


@query
def size_hist(spark, sf):
    return report.size_histogram(records(spark, sf), F.lower(F.substring("business_name", 1, 2)), "country", 12, 3.0)


ORACLES["size_hist"] = f"""WITH {RECORDS}, b AS (SELECT country, lower(substr(business_name, 1, 2)) AS k, count(*) AS n FROM rec GROUP BY ALL)
SELECT country, CAST(least(13, floor(log10(n) / 0.25) + 1) AS BIGINT) AS bucket, count(*) AS n FROM b GROUP BY ALL"""


@query
def norm_words(spark, sf):
    return records(spark, sf).select("entity_id", T.norm(F.col("business_name")).alias("norm"))


ORACLES["norm_words"] = rf"""WITH {RECORDS} SELECT entity_id, trim(regexp_replace(strip_accents(lower(business_name)), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')) AS norm FROM rec"""


@query
def sample_of_tests(spark, sf):
    rows = records(spark, sf).select("entity_id")
    kept = sample.sample_test({f"ts{i}": rows.filter(F.col("entity_id").startswith(f"S{i}-")) for i in (1, 2, 3)}, 0.2)
    return kept["ts1"].union(kept["ts2"]).union(kept["ts3"])


ORACLES["sample_of_tests"] = f"""WITH {RECORDS}, {CRC} SELECT entity_id FROM rec, crc WHERE {crc_sql("'ts' || substr(entity_id, 2, 1) || entity_id")} % 1000000 < 200000"""


@query
def capped_sample(spark, sf):
    return folds.capped(table(spark, sf, "orders"), 500, "o_orderkey").select("o_orderkey", "o_totalprice")


ORACLES["capped_sample"] = f"WITH {CRC} SELECT o_orderkey, o_totalprice FROM orders, crc ORDER BY {crc_sql(chr(39) + '0:' + chr(39) + ' || o_orderkey')}, o_orderkey LIMIT 500"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

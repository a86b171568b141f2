"""URL filter: fixed rules, else empirical-Bayes reputation of the host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import UPPER, only, table

#: (verdict, host, path): fixed values
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: suffixes of two labels under country domains, where sites are registered below them
SUFFIXES = tuple(
    f"{second}.{country}"
    for country, seconds in {
        "ar": "com edu gob gov int mil net org tur",
        "at": "ac co gv or",
        "au": "asn com edu gov id net org",
        "bd": "ac com edu gov net org",
        "br": "adv art blog com eco edu emp eng gov ind inf jus leg med mil net org tv",
        "cn": "ac com edu gov mil net org",
        "co": "com edu gov mil net nom org",
        "cy": "ac com gov net org",
        "ec": "com edu gob gov net org",
        "eg": "com edu gov net org",
        "es": "com edu gob nom org",
        "gh": "com edu gov org",
        "gr": "com edu gov net org",
        "hk": "com edu gov idv net org",
        "hu": "co info org",
        "id": "ac co desa go mil my net or sch web",
        "il": "ac co gov idf k12 muni net org",
        "in": "ac co edu ernet firm gen gov ind mil net nic org res",
        "ir": "ac co gov id net org sch",
        "jp": "ac ad co ed go gr lg ne or",
        "ke": "ac co go info me mobi ne or sc",
        "kr": "ac co go kg mil ms ne or pe re",
        "lk": "ac com edu gov net org",
        "ma": "ac co gov net org press",
        "mx": "com edu gob net org",
        "my": "com edu gov mil name net org",
        "ng": "com edu gov mil net org sch",
        "np": "com edu gov mil net org",
        "nz": "ac co cri geek gen govt iwi kiwi maori mil net org school",
        "pe": "com edu gob mil net nom org",
        "ph": "com edu gov mil net ngo org",
        "pk": "com edu fam gov net org web",
        "pl": "com edu gov info mil net org waw",
        "pt": "com edu gov int net nome org publ",
        "ro": "com info nom org rec store www",
        "rs": "ac co edu gov in org",
        "ru": "ac com edu gov int mil msk net org pp spb",
        "sa": "com edu gov med net org pub sch",
        "sg": "com edu gov net org per",
        "th": "ac co go in mi net or",
        "tr": "av bel com edu gen gov info k12 mil name net org pol web",
        "tw": "club com ebiz edu game gov idv mil net org",
        "tz": "ac co go me ne or sc",
        "ua": "com edu gov in kiev kyiv lviv net org",
        "ug": "ac co com go ne or org sc",
        "uk": "ac co gov ltd me net nhs org plc police sch",
        "uy": "com edu gub mil net org",
        "ve": "co com edu gob gov info mil net org web",
        "vn": "ac com edu gov info name net org",
        "za": "ac co edu gov law mil net nom org school web",
        "zm": "ac co com edu gov net org sch",
        "zw": "ac co gov mil org",
    }.items()
    for second in seconds.split()
)
MOST_BAD = 0.5
Z = 1.645


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    tail = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(tail, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(tail, r"(?s)^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.when(rest, host).otherwise(empty), F.when(rest, path).otherwise(empty)


def domain_and_suffix(bare: Column, suffixes) -> tuple[Column, Column]:
    """Of a host without a port. An IP address is both, as nothing is registered in it."""
    address = bare.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | bare.startswith("[")
    two = F.substring_index(bare, ".", -2)
    below = two.isin(*suffixes)
    domain = F.when(address, bare).when(below, F.substring_index(bare, ".", -3)).otherwise(two)
    suffix = F.when(address, bare).when(below, two).otherwise(F.substring_index(bare, ".", -1))
    return domain, suffix


def _fitting(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule as a struct of rule and verdict, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        one = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, one).otherwise(found)
    return found


def _spread(groups: DataFrame, n: str, k: str) -> DataFrame:
    """The beta-binomial concentration of a level's groups, by the method of moments."""
    sums = groups.filter(F.col(n) > 0).agg(
        F.count(F.lit(1)).cast("double").alias("g"),
        F.sum(n).cast("double").alias("n"),
        F.sum(k).cast("double").alias("k"),
        F.sum((F.col(k) * F.col(k) / F.col(n)).cast("decimal(38,6)")).cast("double").alias("kk"),
        F.sum(F.col(n) * F.col(n)).cast("double").alias("nn"),
    )
    return sums.selectExpr(
        """CASE WHEN n > 0 AND k > 0 AND k < n AND n - nn / n - (g - 1) > 0 THEN
             1 / greatest(0.001D, least(0.999D,
               ((kk - k * k / n) / (k / n * (1 - k / n)) - (g - 1)) / (n - nn / n - (g - 1)))) - 1
           ELSE 1D END AS s"""
    )


def url_verdicts(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    most_bad: float = MOST_BAD,
    z: float = Z,
    id_col: str = "page_id",
    url_col: str = "url",
    suffixes=SUFFIXES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, labelled, bad_rate, bad_bound.

    `outcomes` (id, bad boolean) are labelled pages; rows with a null in either column are
    no outcome. The longest fitting rule decides. Without one the host is blocked if the
    lower `z` bound of its posterior bad rate is above `most_bad`. The posterior shrinks
    the host's outcomes to its registered domain's mean, that to its suffix's, that to the
    mean of all (0.5 without outcomes); each level's concentration is fitted to the
    data. The registered domain is one label more than the suffix, of the host without a port;
    the suffix is the last two labels if `suffixes` has them, else the last. An IP address has
    no other domain and suffix than itself.

    A url that is null or has no `://` has an empty host and path, and is judged as the host ''.
    Repeated rows and ids count each time. An empty table gives no rows.

    Outcomes are summed by host in the task that reads them; pages meet only a row per
    host. That join is dealt on a key of its own, so that a large host can be split.
    """
    host, path = host_and_path(F.col("url"))
    rows = only(pages, page_id=id_col, url=url_col).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    marks = (
        outcomes.select("id", "bad")
        .filter("id IS NOT NULL AND bad IS NOT NULL")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    )
    zero = F.lit(0).cast("long")
    domain, suffix = domain_and_suffix(F.col("bare"), suffixes)
    hosts = (
        rows.join(marks, F.col("page_id") == F.col("id"), "left")
        .groupBy("host")
        .agg(F.coalesce(F.sum("n"), zero).alias("n"), F.coalesce(F.sum("k"), zero).alias("k"))
        .withColumn("bare", F.regexp_replace("host", ":[0-9]*$", ""))
        .withColumn("domain", domain)
        .withColumn("suffix", suffix)
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    mean = suffixes.agg(F.sum("sk").alias("k"), F.sum("sn").alias("n")).selectExpr(
        "CASE WHEN n > 0 THEN cast(k AS double) / n ELSE 0.5D END AS m"
    )
    suffixes = suffixes.select(
        "suffix", mean.scalar().alias("m"), _spread(suffixes, "sn", "sk").scalar().alias("s"), "sn", "sk"
    ).selectExpr("suffix", "(sk + s * m) / (sn + s) AS sm")
    domains = (
        domains.withColumn("s", _spread(domains, "dn", "dk").scalar())
        .join(suffixes, "suffix")
        .selectExpr("domain", "(dk + s * sm) / (dn + s) AS dm")
    )
    hosts = (
        hosts.withColumn("s", _spread(hosts, "n", "k").scalar())
        .join(domains, "domain")
        .selectExpr("host", "n", "s", "(k + s * dm) / (n + s) AS p")
        .selectExpr("host", "n", "p", f"p - {z}D * sqrt(p * (1 - p) / (n + s + 1)) AS low")
        .select(
            F.xxhash64("host").alias("key"),
            "host",
            F.col("n").alias("labelled"),
            F.round("p", 6).alias("bad_rate"),
            F.round("low", 6).alias("bad_bound"),
        )
    )
    fitting = _fitting(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("bad_bound") > most_bad, "block").otherwise("allow")
    return (
        rows.withColumn("key", F.xxhash64("host"))
        .join(hosts, ["key", "host"])
        .withColumn("fit", fitting)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce(F.col("fit.verdict"), judged).alias("verdict"),
            "labelled",
            "bad_rate",
            "bad_bound",
        )
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """A page is bad if its label, by equal id, says low quality or toxic."""
    return only(labels, id="doc_id", quality="quality", toxic="toxic").selectExpr(
        "id",
        """CASE WHEN quality IS NOT NULL OR toxic IS NOT NULL
           THEN coalesce(quality = 0, false) OR coalesce(toxic = 1, false) END AS bad""",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))


def _fit_sql() -> str:
    whens = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        f" THEN ['{h}{p}', '{v}']"
        for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    return f"CASE {whens} END"


def _spread_sql(table_name: str, n: str, k: str) -> str:
    return f"""(SELECT CASE WHEN n > 0 AND k > 0 AND k < n AND n - nn / n - (g - 1) > 0 THEN
        1 / greatest(0.001, least(0.999,
          ((kk - k * k / n) / (k / n * (1 - k / n)) - (g - 1)) / (n - nn / n - (g - 1))))::double - 1
      ELSE 1::double END AS s
      FROM (SELECT count(*)::double AS g, sum({n})::double AS n, sum({k})::double AS k,
              sum(({k} * {k} / {n})::decimal(38, 6))::double AS kk, sum({n} * {n})::double AS nn
            FROM {table_name} WHERE {n} > 0))"""


_SUFFIXES = ", ".join(f"'{s}'" for s in SUFFIXES)

SQL = f"""
WITH r AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail
  FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
l AS (
  SELECT doc_id AS id, count(*) AS n,
         sum((coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::bigint) AS k
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
h0 AS (
  SELECT host, coalesce(sum(n), 0)::bigint AS n, coalesce(sum(k), 0)::bigint AS k,
         regexp_replace(host, ':[0-9]*$', '') AS bare
  FROM p LEFT JOIN l ON page_id = id GROUP BY host),
h1 AS (
  SELECT *, array_to_string(string_split(bare, '.')[-2:], '.') AS two,
         regexp_matches(bare, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$') OR starts_with(bare, '[') AS address FROM h0),
h AS (
  SELECT host, n, k,
         CASE WHEN address THEN bare WHEN two IN ({_SUFFIXES}) THEN array_to_string(string_split(bare, '.')[-3:], '.')
              ELSE two END AS domain,
         CASE WHEN address THEN bare WHEN two IN ({_SUFFIXES}) THEN two
              ELSE string_split(bare, '.')[-1] END AS suffix
  FROM h1),
d AS (SELECT domain, suffix, sum(n)::bigint AS dn, sum(k)::bigint AS dk FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(dn)::bigint AS sn, sum(dk)::bigint AS sk FROM d GROUP BY ALL),
m AS (SELECT CASE WHEN sum(sn) > 0 THEN sum(sk)::double / sum(sn)::double ELSE 0.5 END AS m FROM s),
s2 AS (
  SELECT suffix, (sk + c.s * m.m) / (sn + c.s) AS sm FROM s, m, {_spread_sql("s", "sn", "sk")} c),
d2 AS (
  SELECT domain, (dk + c.s * sm) / (dn + c.s) AS dm
  FROM d JOIN s2 USING (suffix), {_spread_sql("d", "dn", "dk")} c),
h2 AS (
  SELECT host, n, c.s AS s, (k + c.s * dm) / (n + c.s) AS b
  FROM h JOIN d2 USING (domain), {_spread_sql("h", "n", "k")} c),
h3 AS (
  SELECT host, n AS labelled, round(b, 6) AS bad_rate,
         round(b - {Z}::double * sqrt(b * (1 - b) / (n + s + 1)), 6) AS bad_bound FROM h2),
f AS (SELECT p.*, labelled, bad_rate, bad_bound, {_fit_sql()} AS fit FROM p JOIN h3 USING (host))
SELECT page_id, host, path, fit[1] AS rule,
       coalesce(fit[2], CASE WHEN bad_bound > {MOST_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
       labelled, bad_rate, bad_bound
FROM f
"""

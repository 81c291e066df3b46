"""URL filter: host and path rules first, then two character language models.

Urls that a rule allows or blocks are the accepted and the rejected texts. For each of the
two a variable-order Markov model is counted (Witten-Bell smoothing: a context mixes its
own counts with the next shorter context, in proportion to how many characters it has seen
follow). A url's score is its log-likelihood difference divided by its length, in millionths
of a nat, so sums are exact integers. One in four ruled urls (by hash of the id) is kept out of
the counts and calibrates the threshold: the one that weighs both kinds of error alike.

The models count and score whole urls, scheme, query string and fragment too; host and path
are for the rules.

Defined cases: null urls and urls without ``://`` have empty host and path; a null url is scored as
an empty text; repeated rows and null ids each give a row; texts that occur often are scored
once; without ruled urls all differences are 0 and the verdict is allow; an empty table gives
no rows; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import store

# The rules of the result contract, (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
ORDER = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x02", "\x03"
STEP = 10_000  # width of a calibration bin, in millionths of a nat


def read_text(url: Column, host: Column) -> Column:
    """What the language models read: the whole url, its host lower-cased."""
    url = F.coalesce(url, F.lit(""))
    start = F.locate("://", url)
    folded = F.concat(F.substring(url, F.lit(1), start + 2), host, F.substring(url, start + 3 + F.length(host), F.length(url)))
    return F.when(start > 0, folded).otherwise(url)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict); null if none does."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    return F.array_max(F.array(*fits))


def grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per character of a text (and its end): the character after its context."""
    padded = F.concat(F.lit(START * order), F.col("text"), F.lit(END))
    return (texts.withColumn("padded", padded)
            .withColumn("i", F.explode(F.sequence(F.lit(1), F.length("padded") - order)))
            .withColumn("gram", F.substr("padded", F.col("i"), F.lit(order + 1))).drop("padded", "i"))


def language_models(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``counts`` (gram, a, b): occurrences in accepted and rejected texts, 0 for grams that
    are only to be scored. Returns (gram, llr): the smoothed log ratio in millionths."""
    v = counts.agg(F.count_distinct(F.right("gram", F.lit(1)))).scalar()
    below = None
    for k in range(order + 1):
        level = (counts.groupBy(F.right("gram", F.lit(k + 1)).alias("g"))
                 .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
        ctx = (level.groupBy(F.left("g", F.lit(k)).alias("ctx"))
               .agg(F.sum("a").alias("na"), F.sum("b").alias("nb"),
                    F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("b") > 0).alias("tb")))
        level = level.withColumn("ctx", F.left("g", F.lit(k))).join(ctx, "ctx")
        if below is None:
            level = level.withColumns({"qa": F.lit(1.0) / v, "qb": F.lit(1.0) / v})
        else:
            level = level.withColumn("s", F.right("g", F.lit(k))).join(
                below.select(F.col("g").alias("s"), F.col("pa").alias("qa"), F.col("pb").alias("qb")), "s")
        mix = lambda n, t, tot, q: F.when(F.col(tot) == 0, F.col(q)).otherwise(
            (F.col(n) + F.col(t) * F.col(q)) / (F.col(tot) + F.col(t)))
        below = level.select("g", mix("a", "ta", "na", "qa").alias("pa"), mix("b", "tb", "nb", "qb").alias("pb"))
    return below.select(F.col("g").alias("gram"),
                        F.round((F.ln("pa") - F.ln("pb")) * 1e6).cast("long").alias("llr"))


def threshold(scored: DataFrame) -> Column:
    """The bin edge with the least balanced error over held-out (score, verdict) rows; 0
    without both kinds. Bins are few: scores are bounded logarithms."""
    bins = (scored.groupBy(F.floor(F.col("score") / STEP).alias("bin"))
            .agg(F.count_if(F.col("verdict") == "allow").alias("a"),
                 F.count_if(F.col("verdict") == "block").alias("b")))
    packed = bins.agg(F.array_sort(F.collect_list(F.struct("bin", "a", "b"))).alias("bins"))
    total = lambda n: F.aggregate("bins", F.lit(0).cast("long"), lambda s, x: s + x[n])
    part = lambda n, cond: F.aggregate(F.filter("bins", cond), F.lit(0).cast("long"), lambda s, x: s + x[n])
    errors = packed.withColumns({"na": total("a"), "nb": total("b")}).withColumn("best", F.array_min(F.transform(
        "bins", lambda e: F.struct(
            (part("a", lambda x: x["bin"] < e["bin"]) * F.col("nb")
             + part("b", lambda x: x["bin"] >= e["bin"]) * F.col("na")).alias("error"),
            e["bin"].alias("bin")))))
    return F.coalesce(errors.select(F.when((F.col("na") > 0) & (F.col("nb") > 0), F.col("best.bin") * STEP)
                                    ).scalar(), F.lit(0))


def judge_urls(pages: DataFrame, rules=RULES, order: int = ORDER, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per row of ``pages``."""
    url = F.col(f"`{url_col}`")
    judged = (pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), url.alias("url"))
              .withColumn("text", read_text(F.col("url"), F.col("host"))).drop("url")
              .withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
              .withColumn("held", F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 1)
                          .isin("0", "1", "2", "3")))
    use = lambda v: F.sum(F.when((F.col("best.verdict") == v) & ~F.col("held"), 1).otherwise(0))
    texts = judged.groupBy("text").agg(use("allow").alias("a"), use("block").alias("b"))
    counts = store(grams(texts, order).groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-grams")
    llr = store(language_models(counts, order), "url-model")
    scores = (grams(texts.select("text"), order).join(llr, "gram")
              .groupBy("text").agg(F.floor(F.sum("llr") / F.count("*")).cast("long").alias("score")))
    scored = store(judged.join(scores, "text"), "url-scores")
    held_out = scored.where(F.col("held") & F.col("best").isNotNull()).select("score", F.col("best.verdict").alias("verdict"))
    return scored.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce(F.col("best.verdict"), F.when(F.col("score") >= threshold(held_out), "allow")
                                    .otherwise("block")).alias("verdict"), "score")


def oracle_sql(rules=RULES, order: int = ORDER) -> str:
    """The same judgement for DuckDB."""
    fits = ", ".join(
        f"CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
        f"THEN {{'length': {len(h + p)}, 'rule': '{h + p}', 'verdict': '{v}'}} END" for h, p, v in rules)
    parts = [f"""WITH split AS (
  SELECT page_id, coalesce(url, '') AS url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
cut AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS h, regexp_extract(rest, '^[^?#]*') AS hp FROM split),
named AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host, substr(hp, length(h) + 1) AS path,
  CASE WHEN strpos(url, '://') > 0 THEN left(url, strpos(url, '://') + 2) || translate(h, '{UPPER}', '{LOWER}') || substr(rest, length(h) + 1)
  ELSE url END AS text FROM cut),
ruled AS (SELECT *, list_max(list_filter([{fits}], lambda x: x IS NOT NULL)) AS best FROM named),
judged AS (SELECT page_id, host, path, text, best.rule AS rule, best.verdict AS ruled,
  substr(md5(coalesce(page_id::VARCHAR, '')), 1, 1) IN ('0', '1', '2', '3') AS held FROM ruled),
texts AS (SELECT text, sum((ruled IS NOT DISTINCT FROM 'allow' AND NOT held)::INT) AS a,
  sum((ruled IS NOT DISTINCT FROM 'block' AND NOT held)::INT) AS b FROM judged GROUP BY text),
padded AS (SELECT text, a, b, repeat(chr(2), {order}) || text || chr(3) AS p FROM texts),
grams AS (SELECT text, a, b, substr(p, i, {order + 1}) AS gram
  FROM (SELECT *, unnest(range(1, length(p) - {order} + 1)) AS i FROM padded)),
counts AS (SELECT gram, sum(a) AS a, sum(b) AS b FROM grams GROUP BY gram),
letters AS (SELECT count(DISTINCT right(gram, 1)) AS v FROM counts)"""]
    for k in range(order + 1):
        tail = f"right(gram, {k + 1})"
        ctx = f"left(g, {k})" if k else "''"
        base = "1.0::DOUBLE / v AS qa, 1.0::DOUBLE / v AS qb" if not k else "q.pa AS qa, q.pb AS qb"
        source = "letters" if not k else f"p{k - 1} q"
        on = "" if not k else f"WHERE q.g = right(n.g, {k})"
        parts.append(f"""n{k} AS (SELECT {tail} AS g, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1),
c{k} AS (SELECT {ctx} AS ctx, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb
  FROM n{k} GROUP BY 1),
j{k} AS (SELECT n.g, n.a, n.b, c.na, c.nb, c.ta, c.tb, {base} FROM n{k} n
  JOIN c{k} c ON c.ctx = {'left(n.g, ' + str(k) + ')' if k else "''"}, {source} {on}),
p{k} AS (SELECT g, CASE WHEN na = 0 THEN qa ELSE (a::DOUBLE + ta * qa) / (na + ta)::DOUBLE END AS pa,
  CASE WHEN nb = 0 THEN qb ELSE (b::DOUBLE + tb * qb) / (nb + tb)::DOUBLE END AS pb FROM j{k})""")
    parts.append(f"""model AS (SELECT g AS gram, round((ln(pa) - ln(pb)) * 1e6)::BIGINT AS llr FROM p{order}),
scores AS (SELECT text, floor(sum(llr)::DOUBLE / count(*))::BIGINT AS score FROM grams JOIN model USING (gram) GROUP BY text),
bins AS (SELECT floor(score::DOUBLE / {STEP})::BIGINT AS bin, count(*) FILTER (ruled = 'allow') AS a,
  count(*) FILTER (ruled = 'block') AS b FROM judged JOIN scores USING (text) WHERE held AND ruled IS NOT NULL GROUP BY 1),
tot AS (SELECT sum(a) AS na, sum(b) AS nb FROM bins),
errors AS (SELECT e.bin, coalesce(sum(x.a) FILTER (x.bin < e.bin), 0) * any_value(nb)
  + coalesce(sum(x.b) FILTER (x.bin >= e.bin), 0) * any_value(na) AS error
  FROM bins e, bins x, tot WHERE na > 0 AND nb > 0 GROUP BY e.bin),
edge AS (SELECT coalesce((SELECT bin * {STEP} FROM errors ORDER BY error, bin LIMIT 1), 0) AS t)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= t THEN 'allow' ELSE 'block' END) AS verdict, score
FROM judged JOIN scores USING (text), edge""")
    return ",\n".join(parts)

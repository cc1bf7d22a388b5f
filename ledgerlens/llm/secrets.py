"""Secret scans over an incremental blob ledger.

Every version of every text is content-addressed by its SHA-256 (its blob).
The ledger is a Parquet table with one row per scanned blob: the rule
versions that have seen it and the spans they found. A scan reads the ledger,
scans only pairs of blob and rule version it does not hold, each distinct
blob once however many paths carry it, appends the result, and joins the
spans of all blobs back to all paths. Raising a rule's version makes only
that rule run again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.common import id_and_text, read_table, shared_folder, small_arrow_batches, written


class Rule:
    """A kind of secret: pattern, version, and the shortest accepted group.
    ``hints`` are lower-case strings of which a text must hold one (in either
    case) for the pattern to match anywhere; empty: always searched. ``search``
    finds the pattern's matches in linear time where the pattern itself would
    start over at every character of a long run."""

    def __init__(self, kind: str, version: int, pattern: str, group: int = 0, least: int = 0,
                 hints: tuple[str, ...] = (), any_case: bool = False,
                 search: Callable[[str], list[tuple[int, int]]] | None = None):
        self.search = search
        self.kind, self.group, self.least = kind, group, least
        self.key = f"{kind}@{version}"
        self.pattern = re.compile(pattern, re.ASCII | (re.IGNORECASE if any_case else 0))
        self.hints = [h.encode() for h in hints]

    def spans(self, text: str, lowered: bytes) -> list[tuple[int, int]]:
        """Leftmost non-overlapping matches; those with a short group drop out
        after matching, so they still cover what they matched."""
        if self.hints and not any(h in lowered for h in self.hints):
            return []
        if self.search is not None:
            return self.search(text)
        return [m.span() for m in self.pattern.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


#: A private key from its BEGIN line over headers and body to the END line. If
#: no END line comes before other dashes: headers, then the run of pieces of 16
#: or more base64 characters and one shorter piece; the shorter piece alone only
#: at the end of the text. Line breaks may be escaped, quoted or marked.
_GAP = r"""(?:\\[nrt]|<br\x20?/?>|[\s"'>|#*;,+\\])"""
_BASE64 = "[A-Za-z0-9+/=]"
PRIVATE_KEY = (
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----(?:"
    r"(?:[^-]++|-(?!----))*+-----END [A-Z0-9 ]*PRIVATE KEY-----"
    rf"|(?:{_GAP}*+[A-Z][A-Za-z-]*+:[\x20\t]*+[^\s\\]++)*+"
    rf"(?:(?:{_GAP}*+{_BASE64}{{16,}}+)++(?:(?<!=){_GAP}++{_BASE64}++)?+|{_GAP}*+{_BASE64}++(?=\s*\Z)))?+")

_LOGIN_END = re.compile(r"://[^\s:/@]+:[^\s:/@]+@", re.ASCII)
_SCHEME, _SCHEME_INNER = "abcdefghijklmnopqrstuvwxyz0123456789+.-", "0123456789+.-"


def logins(text: str) -> list[tuple[int, int]]:
    """Matches of the rule 'login': found from "://", then back over the run of
    scheme characters to its first letter."""
    found, end = [], 0
    for m in _LOGIN_END.finditer(text):
        head = text[end:m.start()]
        scheme = head[len(head.rstrip(_SCHEME)):].lstrip(_SCHEME_INNER)
        end = m.end()
        if scheme:
            found.append((m.start() - len(scheme), end))
    return found


_RUNS = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", re.ASCII)


def web_tokens(text: str) -> list[tuple[int, int]]:
    """Matches of the rule 'jwt': whole runs joined by dots; the first may have
    other characters before its "eyJ"."""
    found, at = [], 0
    while m := _RUNS.search(text, at):
        first = m.group(1).find("eyJ")
        if first >= 0 and len(m.group(1)) - first - 3 >= 8:
            found.append((m.start() + first, m.end()))
            at = m.end()
        else:
            at = m.end(1) + 1  # the second run may be a first one
    return found


#: Fixed rules first, in the order spans of one start are listed; then known
#: token shapes of widely used services.
RULES = [
    Rule("assign", 1, r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         1, 8, ("password", "passwd", "secret", "token", "apikey", "api_key"), any_case=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("key", 2, PRIVATE_KEY, hints=("private key",)),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", 1, r"xox[abeoprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",), search=web_tokens),
    Rule("login", 1, r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]+@", hints=("://",), search=logins),
]

BASE_KINDS = ("assign", "access", "hex")
SPAN = "struct<kind: string, rule: string, start: long, stop: long>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


def find(text: str, rules=RULES) -> list[tuple[str, str, int, int]]:
    """(kind, rule, start, stop) of all rules, by start, then rule order."""
    lowered = text.encode("utf-8", "surrogatepass").lower()
    found = [(start, n, stop) for n, r in enumerate(rules) for start, stop in r.spans(text, lowered)]
    return [(rules[n].kind, rules[n].key, start, stop) for start, n, stop in sorted(found)]


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """(blob, rules, spans), one row per blob; empty before the first scan."""
    try:
        rows = spark.read.schema(LEDGER).parquet(f"{folder}/*")
    except Exception as missing:  # no batch was appended yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], LEDGER)
    # A row per scan of a blob. Scans that ran at once may both have seen a rule
    # version as unseen; they found the same spans, which count once.
    return rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"),
                                    F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))


def scan_blobs(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
               rules=RULES) -> DataFrame:
    """Scan what the ledger in ``folder`` lacks, append it, and return
    (blob, spans) of the blobs in which the given rules found anything, spans
    by start and rule order, as a written table: a join with it starts from
    plain shuffles, which adaptive execution can split where one blob has
    very many paths.

    A null text counts as the empty blob; an empty table appends nothing.
    A batch's files appear when its job commits; one that was cut short adds
    nothing, and the next scan sees its pairs as unseen.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    rows = id_and_text(docs, id_col, text_col).withColumn("blob", F.unhex(F.sha2("_text", 256)))
    ledger = read_ledger(spark, folder)
    wanted = F.array(*[F.lit(r.key) for r in rules])
    if ledger.isEmpty():
        fresh = rows.groupBy("blob", "_text").agg(F.count(F.lit(1)).alias("_n")).withColumn("todo", wanted)
    else:
        todo = (rows.select("blob").distinct().join(ledger.select("blob", "rules"), "blob", "left")
                .withColumn("todo", F.array_except(wanted, F.coalesce("rules", F.expr("cast(array() as array<string>)"))))
                .where(F.size("todo") > 0).select("blob", "todo"))
        fresh = rows.join(todo, "blob").groupBy("blob", "_text", "todo").agg(F.count(F.lit(1)).alias("_n"))
    by_key = {r.key: r for r in rules}
    span = pa.struct([("kind", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, todo in zip(batch["_text"].to_pylist(), batch["todo"].to_pylist()):
                found.append([dict(zip(("kind", "rule", "start", "stop"), s))
                              for s in find(text, [by_key[k] for k in todo])])
            yield pa.RecordBatch.from_arrays(
                [batch["blob"], batch["todo"], pa.array(found, pa.list_(span))], names=["blob", "rules", "spans"])

    batch = shared_folder(spark, "batch").rsplit("/", 1)[1]
    (fresh.select("blob", "_text", "todo").mapInArrow(search, LEDGER)
     .write.parquet(f"{folder}/{batch}"))
    order = F.create_map(*[x for n, r in enumerate(rules) for x in (F.lit(r.key), F.lit(n))])
    known = read_ledger(spark, folder).select("blob", F.expr("filter(spans, s -> s.rule in ({}))".format(
        ", ".join(f"'{r.key}'" for r in rules))).alias("spans")).where(F.size("spans") > 0)
    sort = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), order[s["rule"]].alias("n"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    known = known.select("blob", F.sort_array(sort).alias("spans"))
    return written(known, "secret-spans")


def scan(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
         rules=RULES) -> DataFrame:
    """``scan_blobs``, joined back to all paths: one row per input row, (id,
    blob, spans). Repeated rows and other paths of a blob all get its spans;
    an empty table gives no rows; other columns are ignored."""
    known = scan_blobs(docs, folder, id_col, text_col, rules)
    rows = id_and_text(docs, id_col, text_col).select("_id", F.unhex(F.sha2("_text", 256)).alias("blob"))
    none = F.expr("cast(array() AS array<struct<start: bigint, n: int, stop: bigint, kind: string>>)")
    return (rows.join(known, "blob", "left")
            .select(F.col("_id").alias(id_col), "blob", F.coalesce("spans", none).alias("spans")))


def redact(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
           mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mask`` and, if
    there is a column n_chars, that column made right; other rows and columns
    stay as they are."""
    found = scan_blobs(docs, folder, id_col, text_col).withColumnRenamed("spans", "_spans")

    @pandas_udf("string")
    def masked(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        out = []
        for text, a, b in zip(texts, starts, stops):
            end, parts = 0, []
            for start, stop in zip(a, b):
                if start >= end:
                    parts += [text[end:start], mask]
                end = max(end, stop)
            out.append("".join(parts) + text[end:])
        return pd.Series(out)

    cols = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    rows = docs.select(row.alias("_row"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("blob"))
    joined = rows.join(found, "blob", "left")
    text = F.col(f"_row.`{text_col}`")
    # Only rows with a finding pass through Python.
    clean = joined.where("_spans IS NULL").select(*[F.col(f"_row.`{c}`").alias(c) for c in cols])
    changed = joined.where("_spans IS NOT NULL").withColumn("_new", masked(
        text, F.transform("_spans", lambda s: s["start"]), F.transform("_spans", lambda s: s["stop"])))
    new = {text_col: F.col("_new"), "n_chars": F.length("_new")}
    changed = changed.select(*[
        new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in cols])
    return clean.unionByName(changed)


def _listed(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op6_secret_scans(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Secrets in every whole text of ``documents``, with the ledger of earlier
    runs in the folder ``ledger`` or a new one."""
    found = scan(read_table(spark, sf_dir, "documents"), ledger or shared_folder(spark, "secret-ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed("spans").alias("spans"))


QUERIES = {"op6_secret_scans": op6_secret_scans}

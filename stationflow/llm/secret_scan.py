"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every text is content-addressed by its SHA-256. A ledger holds
the (blob, rule, rule version) pairs that were scanned before; only pairs that
it lacks are scanned, each blob once however many paths hold it. Findings are
stored per blob and joined back to all paths.

Match positions come from cutting the text at the matches: the lengths of the
pieces between matches and of the matches themselves, summed up, are the spans
in code points.

Defined cases: a null text is the empty text; repeated rows and copies each get
the findings of their blob; an empty table gives no rows; several matches at one
start are ordered as the rules are listed; other columns are kept out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.shared import fresh
from stationflow.sources import new_shared_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at
    least ``least`` characters. ``version`` changes when the rule does.
    ``screen`` matches every text that has a finding; other texts are not cut."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: str = "1"
    screen: str = ""


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Base rules (patterns fixed by the contract). A run that is too short for
#: ``access`` or ``hex`` holds no later start that is long enough, so the least
#: length stands in the pattern; an ``assign`` match that is dropped for its
#: length still takes its characters, so there it stands in the screen only.
BASE_RULES = (
    Rule("assign", _ASSIGN, 2, 6, screen=_ASSIGN.removesuffix("+)") + "{6,})"),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Further public formats of credentials (fixed values).
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
)
RULES = BASE_RULES + MORE_RULES
LEDGER_SCHEMA = "blob string, kind string, version string"
FINDING_SCHEMA = "blob string, kind string, version string, start long, stop long"
#: Batches that a report scans its table in, one after the other.
BATCHES = 2


def with_blob(versions: DataFrame, text: str = "text") -> DataFrame:
    """Versions with their content address and the text as scanned."""
    body = F.coalesce(F.col(text), F.lit(""))
    return versions.withColumns({"_body": body, "blob": F.sha2(body.cast("binary"), 256)})


def unseen_blobs(addressed: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """Each distinct blob with the kinds of rule that the ledger lacks for it.
    Copies are combined before the shuffle, so a text that fills a third of
    the table moves once per task."""
    blobs = addressed.select("blob", F.col("_body").alias("body")).dropDuplicates(["blob"])
    wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", wanted)
    seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen"))
    todo = F.array_except(wanted, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "body", todo.alias("todo")).where(F.size("todo") > 0)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings ``blob, kind, version, start, stop`` (stop exclusive)."""
    body = F.col("body")
    length = lambda x: F.length(x)
    none = F.array().cast("array<int>")
    cuts = []
    for r in rules:
        due = F.array_contains("todo", f"{r.kind}:{r.version}") & body.rlike(r.screen or r.pattern)
        cuts.append(
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.when(due, F.transform(F.split(body, r.pattern, -1), length)).otherwise(none).alias("gaps"),
                F.when(due, F.transform(F.regexp_extract_all(body, F.lit(r.pattern), F.lit(0)), length)).otherwise(none).alias("lens"),
                F.when(due, F.transform(F.regexp_extract_all(body, F.lit(r.pattern), F.lit(r.group)), _at_least(r.least)))
                .otherwise(F.array().cast("array<boolean>")).alias("good"),
            )
        )
    found = (
        blobs.where(" or ".join(["false"] + [f"body rlike {_quoted(r.screen or r.pattern)}" for r in rules]))
        .select("blob", F.explode(F.array(*cuts)).alias("c"))
        .where(F.exists("c.good", lambda x: x))
        .select("blob", "c.kind", "c.version", F.posexplode(F.arrays_zip("c.gaps", "c.lens", "c.good")).alias("i", "m"))
        .select("blob", "kind", "version", "i", "m.gaps", F.coalesce("m.lens", F.lit(0)).alias("lens"), F.coalesce("m.good", F.lit(False)).alias("good"))
    )
    # The window's group is one rule's matches within one text.
    upto = F.expr("sum(gaps + lens) over (partition by blob, kind order by i rows between unbounded preceding and current row)")
    return found.select("blob", "kind", "version", "good", "lens", upto.cast("long").alias("stop")).where("good").select(
        "blob", "kind", "version", (F.col("stop") - F.col("lens")).alias("start"), "stop"
    )


def _at_least(n: int):
    return lambda x: F.length(x) >= n


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan_versions(
    versions: DataFrame, rules: tuple[Rule, ...] = RULES, *, text: str = "text", ledger: DataFrame | None = None, findings: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(versions with ``blob``, all findings, ledger after the scan).

    ``ledger`` and ``findings`` are what earlier scans returned (and the caller
    stored); the results again hold everything known. Findings of replaced rule
    versions are left out."""
    addressed = with_blob(versions, text)
    due = unseen_blobs(addressed, rules, ledger)
    new = scan_blobs(due, rules)
    done = _pairs(due)
    every = new if findings is None else findings.where(_current(rules)).select(*new.columns).unionByName(new)
    known = done if ledger is None else ledger.select("blob", "kind", "version").unionByName(done)
    return addressed.drop("_body"), every, known


def _pairs(due: DataFrame) -> DataFrame:
    """The ledger's rows for blobs that are scanned."""
    return due.select("blob", F.explode("todo").alias("t")).select(
        "blob", F.substring_index("t", ":", 1).alias("kind"), F.expr("substring(t, locate(':', t) + 1)").alias("version")
    )


def _current(rules: tuple[Rule, ...]) -> str:
    return " or ".join(f"(kind = '{r.kind}' and version = '{r.version}')" for r in rules)


def _stored_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    schema = f"{schema}, run long"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # no run yet
        return spark.createDataFrame([], schema)


def stored_ledger(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ledger, findings) of the complete runs under ``path``, with their run."""
    ledger = _stored_rows(spark, f"{path}/ledger", LEDGER_SCHEMA)
    last = ledger.agg(F.max("run")).first()[0] or 0
    return ledger, _stored_rows(spark, f"{path}/findings", FINDING_SCHEMA).where(F.col("run") <= last)


def scan_into_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, *, text: str = "text") -> None:
    """Scan the (blob, rule, version) pairs of ``versions`` that the ledger under
    ``path`` lacks and add them to it. A run writes its findings, then its ledger
    rows, which complete it: a run that was killed before is unknown and the next
    one takes its number and overwrites its findings. Runs must not overlap."""
    spark = versions.sparkSession
    ledger, _ = stored_ledger(spark, path)
    run = (ledger.agg(F.max("run")).first()[0] or 0) + 1
    due = unseen_blobs(with_blob(versions, text), rules, ledger)
    scan_blobs(due, rules).write.mode("overwrite").parquet(f"{path}/findings/run={run}")
    _pairs(due).write.mode("overwrite").parquet(f"{path}/ledger/run={run}")


def findings_through_ledger(
    versions: DataFrame, rules: tuple[Rule, ...] = RULES, *, ledger_path: str | None = None, batches: int = BATCHES
) -> DataFrame:
    """All findings of the present rules after ``versions`` (columns ``doc_id``
    and ``text``) were scanned through the ledger, in batches of whole documents;
    a blob of an earlier batch or run is not scanned again. Without
    ``ledger_path`` the ledger is a new one in the shared folder."""
    spark = versions.sparkSession
    path = ledger_path or new_shared_folder(spark, "secret-ledger")
    for i in range(batches):
        batch = versions if batches == 1 else versions.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == i)
        scan_into_ledger(batch, path, rules)
    return stored_ledger(spark, path)[1].where(_current(rules)).drop("run")


def spans_by_blob(findings: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """Per blob: counts of the base kinds and the spans as text, ordered by
    start and then as the rules are listed. A group is one text's findings."""
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    rows = F.sort_array(F.collect_list(F.struct("start", place[F.col("kind")].alias("place"), "kind", "stop")))
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    own = F.filter("found", lambda s: s["place"] < base)
    counts = [F.sum((F.col("kind") == r.kind).cast("long")).alias(f"n_{r.kind}") for r in rules[:base]]
    return (
        findings.groupBy("blob").agg(rows.alias("found"), *counts)
        .select("blob", *[f"n_{r.kind}" for r in rules[:base]], F.concat_ws(",", F.transform(own, shown)).alias("base_spans"), F.concat_ws(",", F.transform("found", shown)).alias("spans"), "found")
    )


def secret_report(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, *, ledger_path: str | None = None, batches: int = BATCHES
) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` per row, from
    the findings that the ledger holds after the scan."""
    versions = documents.select("doc_id", "text")
    findings = findings_through_ledger(versions, rules, ledger_path=ledger_path, batches=batches)
    addressed = with_blob(versions)
    per_blob = spans_by_blob(findings, rules).drop("found")
    counts = [F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules[: len(BASE_RULES)]]
    digest = F.sha2(F.coalesce("base_spans", F.lit("")).cast("binary"), 256)
    return addressed.select("doc_id", "blob").join(per_blob, "blob", "left").select(
        "doc_id", *counts, digest.alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans")
    )


def redact_secrets(
    documents: DataFrame, rules: tuple[Rule, ...] = RULES, *, mark: str = "[secret]", ledger_path: str | None = None, batches: int = BATCHES
) -> DataFrame:
    """Documents with every found span replaced by ``mark`` (overlapping spans
    as one) and ``n_chars`` counted again; rows without findings stay as they are."""
    findings = findings_through_ledger(documents.select("doc_id", "text"), rules, ledger_path=ledger_path, batches=batches)
    before = "max(stop) over (partition by blob order by start, stop rows between unbounded preceding and 1 preceding)"
    opened = findings.selectExpr("blob", "start", "stop", f"coalesce(cast(start >= {before} as int), 1) as opens")
    numbered = opened.selectExpr("blob", "start", "stop", "sum(opens) over (partition by blob order by start, stop rows between unbounded preceding and current row) as part")
    parts = numbered.groupBy("blob", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    cuts = parts.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("cuts"))
    cuts = cuts.select(F.col("blob").alias("_blob"), F.col("cuts").alias("_cuts"))
    address = fresh(documents, "_address")
    addressed = documents.withColumn(address, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    joined = addressed.join(cuts, addressed[address] == cuts["_blob"], "left")
    found = cuts["_cuts"].isNotNull()
    text = addressed["text"]
    # What stands between the cuts: from the end of one to the start of the next.
    between = F.transform(
        F.sequence(F.lit(0), F.size(cuts["_cuts"])),
        lambda i: F.substring(
            text,
            (F.when(i == 0, F.lit(0)).otherwise(F.get(cuts["_cuts"], i - 1)["stop"]) + 1).cast("int"),
            (
                F.when(i == F.size(cuts["_cuts"]), F.length(text)).otherwise(F.get(cuts["_cuts"], i)["start"])
                - F.when(i == 0, F.lit(0)).otherwise(F.get(cuts["_cuts"], i - 1)["stop"])
            ).cast("int"),
        ),
    )
    redacted = F.when(found, F.concat_ws(mark, between)).otherwise(text)
    changed = {"text": redacted}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.when(found, F.length(redacted).cast(dict(documents.dtypes)["n_chars"])).otherwise(addressed["n_chars"])
    return joined.select(*[changed[c].alias(c) if c in changed else addressed[c] for c in documents.columns])

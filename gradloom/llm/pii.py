"""Personal data: exact patterns as seeds, and identifiers found by bootstrapped lexical contexts."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradloom.llm.batches import map_arrow, unused
from gradloom.llm.kernels import slices
from gradloom.session import reliable_checkpoint

# The kinds in the order of the contract, and the digits each needs.
KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS, PHONE_DIGITS, IP_PART = (14, 19), (10, 15), 255
# Kind of what only contexts find.
FOUND = "id"
# What a pattern needs to be trusted (distinct surfaces, confidence); what an instance needs.
MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE = 4, 0.8, 0.8
# What a candidate that nothing speaks for counts against a pattern, where a plain word counts one.
OPEN_WEIGHT = 0.5
# Shortest identifier looked at and shortest assigned secret that is a seed, in characters.
MIN_IDENTIFIER, MIN_SECRET = 6, 16
# Context words that are broadcast after counting them; more are shuffled.
SHIPPED_WORDS = 200_000

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The lookbehind changes no match: a match takes whole runs of digits, so none starts inside of a run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^ \t-\r]+")
HAS_DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]")
SECRET = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_+/=.-]+")
ASSIGNED = ("=", ":")
EDGE = "\"'()[]{}<>.,;:!?*#$%&|"

FOUND_SCHEMA = (
    "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
    "base array<struct<start:bigint,kind:int,end:bigint>>, "
    "mentions array<struct<start:bigint,end:bigint,surface:string,seed:boolean,secret:boolean,patterns:array<string>>>"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in ``KINDS``, end) of every base match, sorted; code points, end exclusive.

    Each kind takes its leftmost matches, none overlapping another of its kind; a match that fails its check (parts over
    255, a wrong count of digits, Luhn) is dropped and not retried. Time follows the length of the text.
    """
    spans = _emails(text)
    if HAS_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= IP_PART for p in m.group().split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= CARD_DIGITS[0]:
                digits = NOT_DIGIT.sub("", m.group())
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if PHONE_DIGITS[0] <= len(NOT_DIGIT.sub("", m.group())) <= PHONE_DIGITS[1]:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _emails(text: str) -> list[tuple[int, int, int]]:
    """From each @ to the left over characters of a local part, and to the right over a domain."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((start, 0, domain.end()))
            free = domain.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)
    return spans


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mentions_of(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Identifiers with their lexical patterns: base matches as seeds, and other words that hold a digit as candidates.

    A candidate that has the look of a secret (``MIN_SECRET`` characters or more, letters and digits) and stands behind ``=``
    or ``:`` is marked: it supports patterns as a seed does, but comes out only where a pattern is trusted. A pattern is one of: the word before, the two words before, the word after, the words around; lower case, without
    punctuation at word ends unless a word is nothing else. Where base matches overlap, the first one is the seed.
    """
    if not spans and not HAS_DIGIT.search(text):
        return []
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    spots, covered = [], 0
    for start, _, end in spans:
        if start >= covered:
            spots.append((start, end, True))
        covered = max(covered, end)
    found, at = [], 0
    for low, high in words:
        while at < len(spans) and spans[at][2] <= low:
            at += 1
        if HAS_DIGIT.search(text, low, high):
            start = low + len(text[low:high]) - len(text[low:high].lstrip(EDGE))
            end = low + len(text[low:high].rstrip(EDGE))
            free = at == len(spans) or high <= spans[at][0]
            if free and end - start >= MIN_IDENTIFIER:
                found.append((start, end, False))
    rows, i = [], 0
    for start, end, seed in sorted(found + spots):
        while i < len(words) and words[i][1] <= start:
            i += 1
        after = i
        while after < len(words) and words[after][0] < end:
            after += 1
        before = ["^", "^", *(_plain(text[a:b]) for a, b in words[max(0, i - 2) : i])]
        behind = _plain(text[slice(*words[after])]) if after < len(words) else "$"
        far, near = before[-2:]
        patterns = [f"{near} _", f"{far} {near} _", f"_ {behind}", f"{near} _ {behind}"]
        assigned = i > 0 and text[slice(*words[i - 1])].endswith(ASSIGNED)
        secret = not seed and assigned and end - start >= MIN_SECRET and SECRET.fullmatch(text, start, end) is not None
        rows.append({"start": start, "end": end, "surface": text[start:end].lower(), "seed": seed, "secret": secret, "patterns": patterns})
    return rows


def _plain(word: str) -> str:
    return (word.strip(EDGE) or word).lower()


def _detect(text: str) -> dict:
    spans = base_spans(text)
    kinds = [kind for _, kind, _ in spans]
    listed = ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
    row = {f"n_{name}": kinds.count(i) for i, name in enumerate(KINDS)}
    row["base_sha256"] = hashlib.sha256(listed.encode()).hexdigest()
    row["base"] = [{"start": start, "kind": kind, "end": end} for start, kind, end in spans]
    row["mentions"] = mentions_of(text, spans)
    return row


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def scan_documents(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, base matches and mentions of every row; whole texts, nulls as empty."""
    names = [f.split()[0] for f in FOUND_SCHEMA.split(", ")]
    text = pa.string()
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    mention = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("surface", text), ("seed", pa.bool_()), ("secret", pa.bool_()), ("patterns", pa.list_(text))])
    kinds = [pa.int64()] * 4 + [text, pa.list_(span), pa.list_(mention)]

    def scan(batches):
        for whole in batches:
            for batch in slices(whole.select(["doc_id", "text_key", "text"])):
                rows = [_detect(value or "") for value in batch.column("text").to_pylist()]
                found = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *found], names=["doc_id", "text_key", *names])

    rows = documents.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, scan, f"doc_id {kind}, text_key bigint, {FOUND_SCHEMA}")


def context_words(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """pattern and context: how often its rarest context word stands in the texts, so how many words its slot may hold at most.

    Words of the texts are cut and stripped as those of patterns; places before the first and behind the last word count as
    everywhere. Only words that patterns name are counted, in map tasks first.
    """
    named = patterns.select("pattern", F.explode(F.split("pattern", " ")).alias("word")).where("word NOT IN ('_', '^', '$')").distinct()
    wanted = reliable_checkpoint(named.select("word").distinct())
    few = wanted.limit(SHIPPED_WORDS + 1).count() <= SHIPPED_WORDS
    words = texts.select(F.explode(F.split(F.lower("text"), "[ \\t-\\r]+")).alias("raw")).where("raw <> ''")
    stripped = F.btrim("raw", F.lit(EDGE))
    words = words.select(F.when(stripped == "", F.col("raw")).otherwise(stripped).alias("word"))
    counts = words.join(F.broadcast(wanted) if few else wanted, "word", "left_semi").groupBy("word").count()
    return named.join(counts, "word").groupBy("pattern").agg(F.min("count").alias("context"))


def trusted_mentions(mentions: DataFrame, texts: DataFrame) -> DataFrame:
    """Of (surface, seed, secret, pattern, ...) rows, the candidates whose surface trusted patterns reach, wherever they stand.

    The graph joins patterns with the surfaces they were seen around. A pattern's confidence is the number of its mentions,
    each times the score of its surface, over that number, one, the plain words that stand in its context (``context_words``) and
    ``OPEN_WEIGHT`` of the candidates that are not accepted: what often has plain words in its slot is never trusted. It is trusted with ``MIN_SEEDS`` surfaces of score ``MIN_SCORE`` or more and
    ``MIN_CONFIDENCE``. A surface scores one minus the product of (1 - confidence) over its trusted patterns; base matches and
    assigned secrets score 1 for patterns. Rounds score patterns from surfaces and surfaces from patterns; scores only grow, and
    rounds end when no further surface is accepted. Sums are combined in map tasks first.
    """
    seed = (F.col("seed") | F.col("secret")).cast("double")
    edges = mentions.groupBy("pattern", "surface").agg(F.max(seed).alias("seed"), F.max("seed").alias("base"), F.count("*").alias("c"))
    # Patterns that no round can trust: too few surfaces altogether.
    several = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.sum("seed").alias("seeds")).where(F.col("n") >= MIN_SEEDS)
    edges = reliable_checkpoint(edges.join(several.select("pattern"), "pattern"))
    context = reliable_checkpoint(context_words(edges.groupBy("pattern").agg(F.sum("c").alias("c")), texts))
    total = edges.groupBy("pattern").agg(F.sum("c").alias("all")).join(context, "pattern")
    # Nor those whose slot holds plain words for the most part.
    total = total.select("pattern", "all", F.greatest("all", "context").alias("n")).where(F.col("all") >= MIN_CONFIDENCE * (F.col("n") + 1))
    edges = reliable_checkpoint(edges.join(total.select("pattern", "n"), "pattern"))
    scored, known = edges.withColumn("score", F.col("seed")), -1
    while True:
        confidence = (
            scored.groupBy("pattern", "n")
            .agg(
                F.sum(F.col("c") * F.col("score")).alias("sum"), F.sum("c").alias("all"),
                F.sum((F.col("score") >= MIN_SCORE).cast("int")).alias("seeds"),
            )
            .withColumn("against", F.col("n") - F.col("all") + OPEN_WEIGHT * (F.col("all") - F.col("sum")))
            .select("pattern", (F.col("sum") / (F.col("sum") + F.col("against") + 1)).alias("confidence"), "seeds")
            .where((F.col("seeds") >= MIN_SEEDS) & (F.col("confidence") >= MIN_CONFIDENCE))
            .select("pattern", "confidence")
        )
        doubt = F.exp(F.sum(F.ln(1 - F.col("confidence"))))
        found = edges.where("NOT base").join(confidence, "pattern").groupBy("surface").agg((1 - doubt).alias("found"))
        found = reliable_checkpoint(found.where(F.col("found") >= MIN_SCORE))
        accepted = found.count()
        if accepted == known:
            break
        known = accepted
        scored = reliable_checkpoint(
            edges.join(found, "surface", "left").withColumn("score", F.greatest("seed", F.coalesce("found", F.lit(0.0)))).drop("found")
        )
    return mentions.where(~F.col("seed")).join(found.select("surface"), "surface")


def find_personal_data(documents: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_key, counts and digest of base matches, and ``spans`` (start, kind, end).

    ``spans`` holds all base matches and what contexts add (kind ``len(KINDS)``), by start and kind. A null text has none;
    repeated rows get the same spans; an empty table stays empty. A candidate on top of a base match is never added.
    Context words are counted in ``texts``, by default those of the documents.
    """
    scanned = reliable_checkpoint(scan_documents(documents))
    mentions = scanned.where(F.size("mentions") > 0).select("doc_id", "text_key", F.explode("mentions").alias("m")).select(
        "doc_id", "text_key", "m.start", "m.end", "m.surface", "m.seed", "m.secret", F.explode("m.patterns").alias("pattern")
    )
    span = F.struct(F.col("start"), F.lit(len(KINDS)).alias("kind"), F.col("end"))
    extra = (
        trusted_mentions(mentions, (documents if texts is None else texts).where("text IS NOT NULL"))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(span).alias("extra"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "extra")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    joined = scanned.drop("mentions").join(extra, same, "left")
    spans = F.array_sort(F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.concat("base", "extra")))
    return joined.withColumn("spans", spans).drop("_doc", "_key", "base", "extra")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(documents: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in angle brackets, and n_chars as it then is, if there is such a column.

    Overlapping spans are replaced as one, under the name of the first. Texts without digits and @ hold nothing to find
    and are not joined; the others meet their spans by document and text. Null texts stay null; all rows are kept.
    """
    may_hold = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    suspects = documents.where(may_hold)
    found = find_personal_data(suspects, documents).where(F.size("spans") > 0)
    doc, key, held = unused(documents, "_doc", "_key", "_spans")
    spans = found.groupBy(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).agg(F.first("spans").alias(held))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (text_key(F.col("text")) == F.col(key))
    joined = suspects.join(spans, same, "left").drop(doc, key)
    schema = joined.drop(held).schema
    at, where = joined.columns.index("text"), joined.columns.index(held)

    def replace(batches):
        for batch in batches:
            texts = [
                _replaced(text, spans) for text, spans in zip(batch.column(at).to_pylist(), batch.column(where).to_pylist())
            ]
            columns = [c for i, c in enumerate(batch.columns) if i != where]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    clean = map_arrow(joined, replace, schema)
    if "n_chars" in documents.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return documents.where(~may_hold).unionByName(clean.select(*documents.columns))


def _replaced(text: str | None, spans: list[dict] | None) -> str | None:
    if not spans:
        return text
    out, done = [], 0
    for span in spans:
        if span["start"] >= done:
            out += [text[done : span["start"]], "<", (*KINDS, FOUND)[span["kind"]].upper(), ">"]
            done = span["end"]
        else:
            done = max(done, span["end"])
    return "".join([*out, text[done:]])

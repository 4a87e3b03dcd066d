"""Newswire markup source (A1-A9, B1 render) as a splittable Spark text scan.

The text source itself cuts files at ``"<REUTERS"`` (``lineSep``), so one
file is read by many tasks, every row holds one record, and line ends (LF,
CRLF, bare CR) make no difference. Inside a row, the record's lines are walked once by Spark's
``aggregate`` (a left fold over the line array, JVM-side) that tracks which
element the walk is in and remembers line *positions* only; titles, bodies and
topic lists are cut out of the line array afterwards. Nothing leaves the row,
nothing is collected.

Record rules (what the fold recognises):

* header: a line fully matching ``HEADER``; it gives split, old id, new id;
* ``<TOPICS>…</TOPICS>`` line outside a text section: the topic list (last
  wins); ``</D><D>`` separates labels, ``~`` inside a label splits it too;
* a line containing ``<TEXT…>`` opens a text section unless it also contains
  ``</TEXT>``; the section ends at a line containing ``</TEXT>`` or right
  after a BODY element;
* TITLE / BODY elements inside a text section: one-line elements lose both
  tags and keep the rest of the line; multi-line elements keep the text
  after the open tag, then every following line up to (not including) the
  line holding the close tag;
* ``</REUTERS>`` as a whole line, outside any section, closes the record.

A piece begins a record if a full header line stands at its front and the text
before it ends a line. Any other piece comes of a line that only mentions
``<REUTERS``; it belongs to the record before it (``loose_pieces``), or, before
the first record of a file, to the file's preamble. Which record that is comes
from a scan over the pieces in reading order: they are range-partitioned by
(file, place) without their text, each partition tells where its last record
begins and how its last piece ends, and what the partitions before tell is
carried into the next. Only records that are still open at a cut are put
together and parsed again; after a record's closing line the rest is skipped.

Every record is a document or a reject. Rejects have a reason: ``bad_id`` (a
header id is no 64-bit integer) or ``unclosed_record`` (the record ends inside a
section or without its closing line before the next header). Pieces of unused
splits are routed away before their content is parsed. With ``mode='FAILFAST'``
any reject raises.

Pieces are parsed once: documents, rejects and the FAILFAST test all read the
same kept relation. A file that goes away while it is read is an error, unless
``ignore_missing_files`` is set; Spark then logs each file that it skips. A
header whose own attributes hold ``<REUTERS`` is not recognised.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lookup import DEFAULT_MAX_BROADCAST_BYTES
from ..operators.routing import KEPT_SPLITS
from ..session import materialize

# ---------------------------------------------------------------------------
# Fixed values of the markup format (as the reference recognises it).
HEADER = '<REUTERS.*LEWISSPLIT="(.*?)".*OLDID="(.*?)".*NEWID="(.*?)".*>'
RECORD_CLOSE = "</REUTERS>"
TOPICS_LINE = "<TOPICS>.*</TOPICS>"
TEXT_OPEN = "<TEXT.*?>"
TEXT_CLOSE = "</TEXT>"
TITLE_OPEN, TITLE_CLOSE = "<TITLE>", "</TITLE>"
BODY_OPEN, BODY_CLOSE = "<BODY>", "</BODY>"
# replacements applied, in order, to a topics line before splitting on "~"
TOPIC_REPLACEMENTS = (
    ("<TOPICS><D>", ""),
    ("</D></TOPICS>", ""),
    ("</D><D>", "~"),
    ("<TOPICS>", ""),
    ("</TOPICS>", ""),
)
TOPIC_SEPARATOR = "~"
RECORD_START = "<REUTERS"
# ---------------------------------------------------------------------------

# walk states
_DOC, _TEXT, _TITLE, _BODY, _END = 0, 1, 2, 3, 4

# reasons of pieces that are neither documents nor rejects
NO_HEADER, UNUSED = "no_header", "unused_split"
REJECTS = ("bad_id", "unclosed_record")

DEFAULT_GLOB = "*.sgm"
_PLACE_BYTES = 96   # a place, its home and bookkeeping, in a broadcast


@dataclass
class SgmlCorpus:
    """Parsed documents plus rejected records.

    ``documents``: ``doc_id, old_id, split, title, body, topics, file, block,
    seq`` — ``(file, block, seq)`` is the reading order used by last-wins
    de-duplication. ``rejects``: ``file, reason, value``.
    """

    documents: DataFrame
    rejects: DataFrame
    _kept: list = field(default_factory=list)
    first_reject: tuple[str, str] | None = None   # reason and file, if there is any

    ORDER = ("file", "block", "seq")

    def close(self) -> None:
        for df in self._kept:
            df.unpersist()


def _full(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _at(arr: Column, idx: Column) -> Column:
    """1-based element access that is NULL (never an error) for position 0,
    even when the optimiser evaluates it ahead of the guarding predicate."""
    return F.when(idx > 0, F.try_element_at(arr, F.greatest(idx, F.lit(1))))


def _has(line: Column, token: str) -> Column:
    return F.instr(line, token) > 0


def _step(state: Column, line: Column) -> Column:
    """One line of the record walk. State fields: m (walk state), i (line
    number), tp (topics line), ts/te (title start/close line), bs/be (body
    start/close line); 0 = none. A one-line element has start = close."""
    m, i = state["m"], state["i"] + 1
    tp, ts, te, bs, be = state["tp"], state["ts"], state["te"], state["bs"], state["be"]

    in_doc, in_text = m == _DOC, m == _TEXT
    # cheap substring tests guard every regular expression (And short-circuits)
    is_topics = in_doc & line.startswith("<TOPICS>") & line.rlike(_full(TOPICS_LINE))
    text_tag = _has(line, "<TEXT") & line.rlike(TEXT_OPEN)
    opens_text = in_doc & ~is_topics & text_tag & ~_has(line, TEXT_CLOSE)
    closes_doc = in_doc & ~is_topics & ~text_tag & (line == F.lit(RECORD_CLOSE))
    title_open = in_text & _has(line, TITLE_OPEN)
    body_open = in_text & ~title_open & _has(line, BODY_OPEN)
    text_close = in_text & ~title_open & ~body_open & _has(line, TEXT_CLOSE)
    title_close = (m == _TITLE) & _has(line, TITLE_CLOSE)
    body_close = (m == _BODY) & _has(line, BODY_CLOSE)
    title_one = title_open & _has(line, TITLE_CLOSE)
    body_one = body_open & _has(line, BODY_CLOSE)

    new_m = (F.when(opens_text, F.lit(_TEXT))
             .when(closes_doc, F.lit(_END))
             .when(title_open & ~title_one, F.lit(_TITLE))
             .when(body_open & ~body_one, F.lit(_BODY))
             .when(body_one | text_close | body_close, F.lit(_DOC))
             .when(title_close, F.lit(_TEXT))
             .otherwise(m))
    return F.struct(
        new_m.alias("m"), i.alias("i"),
        F.when(is_topics, i).otherwise(tp).alias("tp"),
        F.when(title_open, i).otherwise(ts).alias("ts"),
        F.when(title_one | title_close, i).when(title_open, F.lit(0)).otherwise(te).alias("te"),
        F.when(body_open, i).otherwise(bs).alias("bs"),
        F.when(body_one | body_close, i).when(body_open, F.lit(0)).otherwise(be).alias("be"),
    )


def _element(lines: Column, start: Column, close: Column, open_tag: str, close_tag: str,
             keep_closing_line: bool = False, strip_inline: bool = False) -> Column:
    """Text of a TITLE/BODY element located by the walk ('' if absent).

    ``keep_closing_line``: the text before the close tag of a multi-line
    element stays (else its whole last line goes). ``strip_inline``: a one-line
    element is only what stands between its tags (else the rest of its line,
    other tags included, stays)."""
    first = _at(lines, start)
    after_open = F.substring(first, F.instr(first, open_tag) + F.lit(len(open_tag)), F.length(first))
    if strip_inline:
        one_line = F.substring_index(after_open, close_tag, 1)
    else:
        one_line = F.replace(F.replace(first, F.lit(open_tag), F.lit("")), F.lit(close_tag), F.lit(""))
    rows = F.concat(F.array(after_open), F.slice(lines, start + 1, F.greatest(close - start - 1, F.lit(0))))
    if keep_closing_line:
        rows = F.concat(rows, F.array(F.substring_index(_at(lines, close), close_tag, 1)))
    return (F.when(start == 0, F.lit(""))
            .when(start == close, one_line)
            .otherwise(F.concat_ws("\n", rows)))


def parse_topics(line: Column) -> Column:
    """A5: topics line -> non-blank labels, in order."""
    s = line
    for old, new in TOPIC_REPLACEMENTS:
        s = F.replace(s, F.lit(old), F.lit(new))
    parts = F.split(s, F.lit(TOPIC_SEPARATOR), -1)
    return F.filter(parts, lambda t: t != F.lit(""))


def read_records(spark: SparkSession, path: str, glob: str = DEFAULT_GLOB,
                 ignore_missing_files: bool = False) -> DataFrame:
    """A1 + A2: one row per piece, ``(value, file, block, seq)``; the first
    piece of every file is its preamble (with the separator before it, too).

    Non-recursive: only files directly in ``path`` whose full name matches
    ``glob`` (case-sensitive).
    """
    reader = spark.read.option("lineSep", RECORD_START)
    if ignore_missing_files:
        reader = reader.option("ignoreMissingFiles", "true")
    try:
        raw = reader.text(f"{path.rstrip('/')}/{glob}")
        files = raw.inputFiles()
    except Exception as exc:  # no match: Spark reports a missing path
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        files = []
    if not files:
        try:
            own = spark.read.text(path).inputFiles()
        except Exception:
            own = []
        if len(own) == 1 and own[0].rstrip("/").endswith(path.rstrip("/")):
            raise NotADirectoryError(f"not a directory: {path}")
        raise FileNotFoundError(f"no {glob} files in {path}")
    return raw.select(F.concat(F.lit(RECORD_START), F.col("value")).alias("value"),
                      F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("seq"))


def parse_records(records: DataFrame, splits: tuple[str, ...] | None = KEPT_SPLITS,
                  keep_closing_line: bool = False, strip_inline: bool = False) -> DataFrame:
    """A2-A9 + C1 on ``(value, file, block, seq)`` rows: the document columns,
    ``file, block, seq``, for pieces that are no documents ``reason`` and ``value``
    (NULL for documents and for unused splits), and what the scan over the
    pieces needs: ``headed``, ``ends_line``, ``bare`` (nothing behind the cut)."""
    lines = F.split(F.regexp_replace(F.col("value"), "\r\n?", "\n"), "\n", -1)
    with_lines = records.select("file", "block", "seq", "value", lines.alias("ln"))
    head = _at(F.col("ln"), F.lit(1))
    has_header = F.coalesce(head.rlike(_full(HEADER)), F.lit(False))
    int_text = r"^[+-]?[0-9]+$"

    def as_id(group: int) -> Column:
        s = F.regexp_extract(head, HEADER, group)
        return F.when(s.rlike(int_text), s.try_cast("bigint"))

    headed = with_lines.select(
        "file", "block", "seq", "value", "ln", has_header.alias("headed"),
        F.when(has_header, F.regexp_extract(head, HEADER, 1)).alias("split"),
        as_id(2).alias("old_id"),
        as_id(3).alias("doc_id"),
    )
    used = F.lit(True) if splits is None else F.col("split").isin(list(splits))   # C1 before any content parsing
    good = F.col("headed") & used & F.col("old_id").isNotNull() & F.col("doc_id").isNotNull()
    rest = F.when(good, F.slice(F.col("ln"), F.lit(2), F.greatest(F.size("ln") - 1, F.lit(1)))) \
        .otherwise(F.array().cast("array<string>"))
    zero = F.lit(0)
    init = F.struct(F.lit(_DOC).alias("m"), zero.alias("i"), zero.alias("tp"), zero.alias("ts"),
                    zero.alias("te"), zero.alias("bs"), zero.alias("be"))
    # The walk's result leaves through a generator (``inline`` of a one-element
    # array): its fields become plain columns, so the optimiser cannot copy the
    # fold into every filter and projection that reads a field, and the fold
    # runs once per record.
    walked = (headed.select("*", good.alias("good"), used.alias("used"), rest.alias("rest"))
              .select("*", F.inline(F.array(F.aggregate("rest", init, _step)))))

    rest_c = F.col("rest")
    reason = (F.when(~F.col("headed"), F.lit(NO_HEADER))
              .when(~F.col("used"), F.lit(UNUSED))
              .when(~F.col("good"), F.lit("bad_id"))
              .when(F.col("m") != _END, F.lit("unclosed_record")))
    return walked.select(
        "doc_id", "old_id", "split",
        _element(rest_c, F.col("ts"), F.col("te"), TITLE_OPEN, TITLE_CLOSE, keep_closing_line, strip_inline).alias("title"),
        _element(rest_c, F.col("bs"), F.col("be"), BODY_OPEN, BODY_CLOSE, keep_closing_line, strip_inline).alias("body"),
        F.when(F.col("tp") > 0, parse_topics(_at(rest_c, F.col("tp"))))
        .otherwise(F.array().cast("array<string>")).alias("topics"),
        "file", "block", "seq",
        reason.alias("reason"), F.when(reason != UNUSED, F.col("value")).alias("value"),
        "headed", F.substring("value", -1, 1).isin("\r", "\n").alias("ends_line"), (F.col("value") == RECORD_START).alias("bare"),
    )


def loose_pieces(parsed: DataFrame) -> DataFrame:
    """The pieces that begin no record although they look like one or follow
    one: ``(fh, block, seq, headed, home)``, ``fh`` a hash of the file and
    ``home`` the place of the record they belong to (NULL in a preamble).

    A scan over narrow rows. Within a partition the piece before and the last
    record's place are found by windows; for the first rows they are carried
    over from the partitions before, of which each gives one row.
    """
    n = int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = parsed.select(F.xxhash64("file").alias("fh"), "block", "seq", "headed", "ends_line", "bare")
    placed = marks.repartitionByRange(n, "fh", "block", "seq").withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, "checkpoint")   # the sampled ranges must not be drawn anew
    inside = Window.partitionBy("_part").orderBy("fh", "block", "seq")
    piece = F.struct("fh", "ends_line", "bare")
    rows = placed.select("*", F.row_number().over(inside).alias("_rn"), F.lag(piece).over(inside).alias("_b1"), F.lag(F.col("fh"), 2).over(inside).alias("_f2"))

    def ends(before: Column, file_before: Column) -> Column:
        # nothing stands before a file's first record but its preamble, which may be empty
        return before["ends_line"] | (before["bare"] & ~before["fh"].eqNullSafe(file_before))

    place = F.struct("fh", "block", "seq")
    begins = F.col("headed") & (F.col("_b1.fh") == F.col("fh")) & ends(F.col("_b1"), F.col("_f2"))
    told = rows.groupBy("_part").agg(
        F.max(F.when((F.col("_rn") > 2) & begins, place)).alias("_last"), F.max(F.struct("fh", "block", "seq", "ends_line", "bare")).alias("_z"),
        F.max(F.when(F.col("_rn") <= 2, F.struct("_rn", "headed", "fh", "block", "seq", "ends_line", "bare"))).alias("_second"),
        F.min(F.struct("_rn", "headed", "fh", "block", "seq", "ends_line", "bare")).alias("_first"), F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("_rn") > 1, F.struct("fh", "block", "seq", F.col("_b1.fh").alias("before")))).alias("_zb"))
    # a row for each partition from here on
    across = Window.orderBy("_part")
    told = told.withColumn("_p1", F.lag("_z").over(across))
    told = told.withColumn("_p2", F.when(F.lag("_n").over(across) > 1, F.lag("_zb.before").over(across)).otherwise(F.lag("_p1.fh").over(across)))
    first, second = F.col("_first"), F.col("_second")
    first_begins = first["headed"] & (F.col("_p1.fh") == first["fh"]) & ends(F.col("_p1"), F.col("_p2"))
    second_begins = (F.col("_n") > 1) & second["headed"] & (first["fh"] == second["fh"]) & ends(first, F.col("_p1.fh"))
    at = lambda x: F.struct(x["fh"].alias("fh"), x["block"].alias("block"), x["seq"].alias("seq"))
    last = F.coalesce("_last", F.when(second_begins, at(second)), F.when(first_begins, at(first)))
    carried = told.select(F.col("_part").alias("_p"), "_p1", "_p2", F.last(last, ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))

    joined = rows.join(F.broadcast(carried), F.col("_part") == F.col("_p"))
    before = F.when(F.col("_rn") > 1, F.col("_b1")).otherwise(F.struct("_p1.fh", "_p1.ends_line", "_p1.bare"))
    file_before = F.when(F.col("_rn") > 2, F.col("_f2")).when(F.col("_rn") == 2, F.col("_p1.fh")).otherwise(F.col("_p2"))
    told = joined.withColumn("_before", before).withColumn("_file2", file_before)
    told = told.withColumn("_begins", F.coalesce(F.col("headed") & (F.col("_before.fh") == F.col("fh")) & ends(F.col("_before"), F.col("_file2")), F.lit(False)))
    so_far = F.last(F.when(F.col("_begins"), place), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    told = told.withColumn("_home", F.coalesce(so_far, F.col("_carried")))
    home = F.when(F.col("_home.fh") == F.col("fh"), F.struct("_home.block", "_home.seq"))
    return told.where(~F.col("_begins")).select("fh", "block", "seq", "headed", home.alias("home")).where(F.col("headed") | F.col("home").isNotNull())


def corpus_of(parsed: DataFrame, records: DataFrame, reparse: Callable[[DataFrame], DataFrame], keep: str = "checkpoint") -> SgmlCorpus:
    """Documents and rejects of kept parsed pieces: records that a line with
    ``<REUTERS`` has cut are put together and parsed again by ``reparse``."""
    columns = [c for c in parsed.columns if c not in ("headed", "ends_line", "bare")]
    kept, n_loose = [parsed], 0
    # A file whose only piece without a header is its preamble, and whose pieces all end a line, has no cut record.
    some = F.when(F.col("reason").isin(*REJECTS), F.struct("reason", "file"))
    headless, files, unended, first = parsed.agg(
        F.count_if(~F.col("headed")), F.count_distinct("file"), F.count_if(~F.col("ends_line") & ~F.col("bare")), F.min(some)).first()
    if headless != files or unended:
        loose = materialize(loose_pieces(parsed), keep)
        kept.append(loose)
        n_loose, n_false = loose.agg(F.count(F.lit(1)), F.count_if(F.col("headed") & F.col("home").isNotNull())).first()
    whole = parsed.where(F.coalesce(F.col("reason") != NO_HEADER, F.lit(True))).select(*columns)
    if n_loose:
        small = lambda df: F.broadcast(df) if n_loose * _PLACE_BYTES <= DEFAULT_MAX_BROADCAST_BYTES else df
        here = [F.xxhash64("file").eqNullSafe(F.col("_fh")), F.col("block") == F.col("_block"), F.col("seq") == F.col("_seq")]
        spots = loose.select(F.col("fh").alias("_fh"), F.col("block").alias("_block"), F.col("seq").alias("_seq"), "home", F.lit(True).alias("_loose"))
        homes = loose.where(F.col("home").isNotNull()).select(
            F.col("fh").alias("_fh"), F.col("home.block").alias("_block"), F.col("home.seq").alias("_seq")).distinct()
        # Records that are cut while they are open; one that is closed needs nothing of what follows it.
        open_ = parsed.where(F.col("reason").isin(*REJECTS))
        cut = materialize(open_.join(small(homes), here).select("_fh", "_block", "_seq", "file", "block", "seq", "value"), keep)
        kept.append(cut)
        belongs = [F.col("_fh") == F.col("_hf"), F.col("home.block") == F.col("_hb"), F.col("home.seq") == F.col("_hs")]
        mine = small(cut.select(F.col("_fh").alias("_hf"), F.col("_block").alias("_hb"), F.col("_seq").alias("_hs")))
        wanted = spots.join(mine, belongs).select("_fh", "_block", "_seq", "_hb", "_hs")
        texts = parsed.where(F.col("value").isNotNull())
        if n_false:   # a header in the middle of a line: what was parsed for a record of its own has not kept its text
            texts = records
        pieces = texts.join(small(wanted), here).select(
            "_fh", F.col("_hb").alias("_block"), F.col("_hs").alias("_seq"), "file", "block", "seq", "value")
        parts = pieces.unionByName(cut).groupBy("_fh", "_block", "_seq").agg(
            F.first("file").alias("file"), F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"))
        again = reparse(parts.select(F.array_join("parts.value", "").alias("value"), "file", F.col("_block").alias("block"), F.col("_seq").alias("seq")))
        again = materialize(again.select(*columns), keep)
        kept.append(again)
        gone = spots.select("_fh", "_block", "_seq").unionByName(cut.select("_fh", "_block", "_seq"))
        whole = whole.join(small(gone), here, "left_anti").unionByName(again)
        first = whole.agg(F.min(some)).first()[0]
    documents = whole.where(F.col("reason").isNull()).drop("reason", "value")
    rejects = whole.where(F.col("reason").isin(*REJECTS)).select("file", "reason", "value")
    return SgmlCorpus(documents, rejects, kept, tuple(first) if first else None)


def read_sgml(spark: SparkSession, path: str, glob: str = DEFAULT_GLOB,
              splits: tuple[str, ...] | None = KEPT_SPLITS, mode: str = "PERMISSIVE",
              keep_closing_line: bool = False, strip_inline: bool = False,
              ignore_missing_files: bool = False, keep: str = "checkpoint") -> SgmlCorpus:
    """Read a directory of markup files into documents and rejects.

    ``splits``: split tags to keep (None keeps every split). ``mode``:
    ``PERMISSIVE`` returns rejects as a relation; ``FAILFAST`` raises on the
    first reject. ``keep``: how the parsed pieces are kept for their readers
    (see ``materialize``). The default writes them to the shared checkpoint
    folder: one parse, and a reading order (``seq``) that no later scan can
    number anew. ``close()`` lets a persisted relation go.
    """
    if mode.upper() not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"unknown mode {mode!r}")
    records = read_records(spark, path, glob, ignore_missing_files)
    parsed = materialize(parse_records(records, splits, keep_closing_line, strip_inline), keep)
    corpus = corpus_of(parsed, records, lambda whole: parse_records(whole, splits, keep_closing_line, strip_inline), keep)
    if mode.upper() == "FAILFAST":
        if corpus.first_reject:
            corpus.close()
            raise ValueError("malformed record ({}) in {}".format(*corpus.first_reject))
    return corpus


def render_records(docs: DataFrame) -> DataFrame:
    """B1 in markup form: one ``value`` per document, a complete record that
    :func:`read_sgml` parses back to the same row (for bodies that hold no
    markup of their own)."""
    topics = F.when(F.size("topics") > 0,
                    F.concat(F.lit("<TOPICS><D>"), F.array_join("topics", "</D><D>"), F.lit("</D></TOPICS>"))) \
        .otherwise(F.lit("<TOPICS></TOPICS>"))
    header = F.format_string('<REUTERS TOPICS="YES" LEWISSPLIT="%s" CGISPLIT="TRAINING-SET" OLDID="%d" NEWID="%d">',
                             F.col("split"), F.col("old_id"), F.col("doc_id"))
    value = F.concat_ws("\n", header, topics, F.lit("<TEXT>"),
                        F.concat(F.lit(TITLE_OPEN), F.col("title"), F.lit(TITLE_CLOSE)),
                        F.concat(F.lit(BODY_OPEN), F.col("body")),
                        F.lit(BODY_CLOSE + TEXT_CLOSE), F.lit(RECORD_CLOSE))
    return docs.select(value.alias("value"))


def write_sgml(docs: DataFrame, path: str) -> None:
    """Write documents as markup text files (one record after another)."""
    render_records(docs).write.mode("errorifexists").text(path)

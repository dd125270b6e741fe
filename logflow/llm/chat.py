"""Chat formatting (10): quotation linking.

Messages may quote earlier ones, a line deep in ``>`` marks (``> > text`` is a
quotation in a quotation).  Each maximal run of lines of one level or deeper
is a quoted passage.  Passages are looked up by units: the whole passage, its
lines and its sentences, each hashed as lower-cased words without marks and
punctuation.  Every message offers the hashes of its own words as a whole and
of its paragraphs, lines and sentences.  A unit's source is the latest earlier
turn of the conversation that offers it.  Among the sources of its units a
passage takes the turn that holds most of its words (a whole passage counts
before any parts; ties go to the later turn), if these are at least half of
them.  The first linked passage of the lowest level names the message replied
to.  A message without a linked quotation replies to the nearest earlier turn;
the first has none.  Conversations are then ordered by reply (depth first,
children by turn), without quotations and the line that announces one ("Ann
wrote:").  Lines that start with three marks or more outside of any quotation
(as a prompt in code does) are no quotations unless their passage is linked.

Depth-first order comes from an Euler tour: every message is entered and left
once, and pointer doubling counts the events from each to the end of its
conversation's tour.  A conversation of n messages takes about log2(2 n)
joins over rows of fixed size; earlier turns and neighbours are found by
sliced scans, so no conversation is gathered in one task.

Null conv_id, turn or text: messages without conv_id or turn cannot be placed
and are left out; null text is empty.  Messages that share conv_id and turn
are one message: the smallest role, then the smallest text (nulls last), is
kept.  A message that consists of quotations only keeps an empty text.  An
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import stored
from logflow.plans.scan import carry_forward, lag

_MARK = re.compile(r"^\s*((?:>\s?)+)")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n\s*\n")
# How a line ends that announces a quotation.
_ANNOUNCES = re.compile(r"\b(?:wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$", re.I)

PARSED = ("text string, code string, offers array<long>, "
          "quotes array<struct<level: int, nth: int, jump: boolean, units: array<struct<hash: long, n: int>>>>")


def passage_hash(text: str) -> int | None:
    """Hash of a passage's words; None if it has none."""
    words = _WORD.findall(text.lower())
    return xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "replace")) - (1 << 63) if words else None


class Passage:
    def __init__(self, level: int, jump: bool):
        self.level, self.jump, self.lines = level, jump, []

    @property
    def text(self) -> str:
        return "\n".join(self.lines)


def parse_message(text: str) -> tuple[str, str, list[Passage]]:
    """A message's own text, the same with the lines that jump to three marks
    or more from none, and its quoted passages in order.  A passage of level k
    goes on through deeper lines, whose own passages follow; deeper lines are
    no part of its text."""
    own: list[tuple[str, bool]] = []
    open_: list[Passage] = []
    found: list[Passage] = []
    for line in text.split("\n"):
        m = _MARK.match(line)
        level = m[1].count(">") if m else 0
        if level and not open_:  # a run begins: the line that announces it goes
            k = len(own) - 1
            while k >= 0 and not own[k][0].strip():
                k -= 1
            if k >= 0 and not own[k][1] and _ANNOUNCES.search(own[k][0]):
                del own[k:]
        jump = level >= 3 and (not open_ or open_[0].jump)
        del open_[level:]
        while len(open_) < level:
            open_.append(Passage(len(open_) + 1, jump))
            found.append(open_[-1])
        if m:
            open_[-1].lines.append(line[m.end():])
        if not m or jump:
            own.append((line, jump))
    return (_tidy(line for line, jump in own if not jump), _tidy(line for line, _ in own), found)


def _tidy(lines) -> str:
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def _parts(text: str) -> list[str]:
    """Lines and sentences; a sentence may run over lines."""
    return [*text.split("\n"), *_SENTENCE.split(text)]


def offered(body: str) -> list[int]:
    parts = [body, *re.split(r"\n\s*\n", body), *_parts(body)]
    return sorted({h for h in map(passage_hash, parts) if h is not None})


def units_of(passage: str) -> list[dict]:
    """Hash and number of words of each unit; the whole passage weighs more
    than all its parts together."""
    units = {h: len(_WORD.findall(x)) for x in _parts(passage) if (h := passage_hash(x)) is not None}
    whole = passage_hash(passage)
    if whole is not None:
        units[whole] = sum(n for h, n in units.items() if h != whole) + len(_WORD.findall(passage))
    return [{"hash": h, "n": n} for h, n in units.items()]


def reply_order(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, reply_to, n_quotes, n_linked, depth,
    position (from 0 in its conversation)."""
    keep = (messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.struct(F.col("role").isNull().alias("a"), F.col("role").cast("string").alias("role"),
                             F.col("text").isNull().alias("b"), F.col("text").cast("string").alias("text")).alias("m"))
            .groupBy("conv_id", "turn").agg(F.min("m").alias("m"))
            .select("conv_id", "turn", "m.role", F.coalesce("m.text", F.lit("")).alias("text")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, codes, offers, quotes = [], [], [], []
            for text in pdf["text"].tolist():
                body, code, found = parse_message(text)
                texts.append(body)
                codes.append(code)
                offers.append(offered(code))
                quotes.append([{"level": q.level, "nth": k, "jump": q.jump, "units": units}
                               for k, q in enumerate(found) if (units := units_of(q.text))])
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"], "role": pdf["role"], "text": texts,
                                "code": codes, "offers": offers, "quotes": quotes})

    parsed = stored(keep.mapInPandas(run, "conv_id long, turn long, role string, " + PARSED), "messages")

    asked = stored(parsed.select("conv_id", "turn", F.explode("quotes").alias("q")).select(
        "conv_id", "turn", "q.level", "q.nth", "q.jump", F.explode("q.units").alias("u")).select(
        "conv_id", "turn", "level", "nth", "jump", "u.hash", "u.n"), "units")
    # only what is asked for somewhere in the conversation is looked up
    said = parsed.select("conv_id", "turn", F.explode("offers").alias("hash")).join(
        asked.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    # the latest earlier turn with the same hash, by one scan over both kinds
    # of rows: no pairs are made when many messages say the same
    both = asked.withColumn("kind", F.lit(1)).withColumn("mark", F.lit(None).cast("long")).unionByName(
        said.withColumn("kind", F.lit(2)).withColumn("mark", F.col("turn")), allowMissingColumns=True)
    found = stored(carry_forward(both, ["conv_id", "hash"], ["turn", "kind"], "mark", "source")
                   .where((F.col("kind") == 1) & F.col("source").isNotNull()), "sources")
    # which of its candidates hold which of a passage's units
    passage = ["conv_id", "turn", "level", "nth", "jump"]
    candidates = found.select(*passage, "source").distinct()
    held = (candidates.join(asked, passage).join(said.select("conv_id", "hash", F.col("turn").alias("source")),
                                                 ["conv_id", "hash", "source"], "left_semi")
            .groupBy(*passage, "source").agg(F.sum("n").alias("words")))
    whole = asked.groupBy(*passage).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    # all parts together weigh n - most, so half of them link a passage
    chosen = (held.join(whole, passage).where(F.col("words") * 2 >= F.least(F.col("n") - F.col("most"), F.col("most")))
              .groupBy(*passage).agg(F.max_by("source", F.struct("words", "source")).alias("source")))
    linked = chosen.groupBy("conv_id", "turn").agg(
        F.min_by("source", F.struct("level", "nth")).alias("source"), F.count(F.lit(1)).alias("n_linked"),
        F.max("jump").alias("cut"))
    nodes = (lag(parsed.select("conv_id", "turn", "role", "text", "code", "quotes"), "conv_id", "turn", "turn")
             .join(linked, ["conv_id", "turn"], "left")
             .select("conv_id", "turn", "role", F.when(F.coalesce("cut", F.lit(False)), F.col("text")).otherwise(F.col("code"))
                     .alias("text"), F.coalesce("source", "prev_turn").alias("reply_to"),
                     F.size(F.filter("quotes", lambda q: ~q["jump"] | F.coalesce("cut", F.lit(False)))).cast("long").alias("n_quotes"),
                     F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")))
    nodes = stored(nodes, "replies")

    # Euler tour: every message is entered and left once; ``next`` leads from
    # one event to the following one of its conversation
    children = nodes.where("reply_to is not null").groupBy("conv_id", F.col("reply_to").alias("turn")).agg(
        F.min("turn").alias("child"))
    tour = lag(nodes.select("conv_id", "turn", "reply_to"), ["conv_id", "reply_to"], "turn", "turn", prefix="next_",
               lead=True).withColumnRenamed("next_turn", "sibling").join(children, ["conv_id", "turn"], "left")
    enter, leave = F.col("turn") * 2, F.col("turn") * 2 + 1
    events = F.array(
        F.struct(enter.alias("event"), F.coalesce(F.col("child") * 2, leave).alias("next"), F.lit(1).alias("step")),
        F.struct(leave.alias("event"), F.coalesce(F.col("sibling") * 2, F.col("reply_to") * 2 + 1).alias("next"),
                 F.lit(-1).alias("step")))
    # pointer doubling: counts from an event to the end of its tour.  After k
    # rounds ``next`` leads 2^k events ahead, so a tour of 2 n events is done
    # after ceil(log2(2 n)) rounds and takes no part in later ones.
    sizes = nodes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    tour = stored(tour.select("conv_id", F.inline(events)).join(sizes, "conv_id").select(
        "conv_id", "event", "next", F.greatest("step", F.lit(0)).cast("long").alias("entered"),
        F.col("step").cast("long").alias("rise"), "size", F.ceil(F.log2(F.col("size") * 2)).cast("int").alias("rounds")),
        "tour")
    last = tour.agg(F.max("rounds")).first()[0] or 0
    done = tour.where("rounds < 1")
    for k in range(1, last + 1):
        rest = tour.where(F.col("rounds") >= k)
        ahead = rest.select("conv_id", F.col("event").alias("next"), F.col("next").alias("n"),
                            F.col("entered").alias("e"), F.col("rise").alias("r"))
        tour = stored(rest.join(ahead, ["conv_id", "next"], "left").select(
            "conv_id", "event", F.col("n").alias("next"), (F.col("entered") + F.coalesce("e", F.lit(0))).alias("entered"),
            (F.col("rise") + F.coalesce("r", F.lit(0))).alias("rise"), "size", "rounds"), "tour")
        done = done.unionByName(tour.where(F.col("rounds") == k))
    placed = done.where("event % 2 = 0").select(
        "conv_id", (F.col("event") / 2).cast("long").alias("turn"), (-F.col("rise")).alias("depth"),
        (F.col("size") - F.col("entered")).alias("position"))
    return nodes.join(placed, ["conv_id", "turn"])


def format_conversations(messages: DataFrame, *, user: str = "<|user|>", other: str = "<|{}|>") -> DataFrame:
    """One formatted message a row, in reply order: ``formatted`` starts with
    a role mark; join a conversation's rows by ``position`` to read it."""
    rows = reply_order(messages)
    role = F.coalesce("role", F.lit("unknown"))
    mark = F.when(role == "user", F.lit(user)).otherwise(F.format_string(other.replace("{}", "%s"), role))
    return rows.withColumn("formatted", F.concat(mark, F.lit("\n"), "text", F.lit("\n")))

"""URL filters: all glob rules at once, by a bit-parallel wildcard automaton.

Rules are packed side by side into the bits of several 64-bit words, one bit per
place within a rule (Shift-And). One step per byte moves the places of all rules
of all URLs of a block: a place whose next letter is the byte read moves on, and
a place before a wildcard may stay. After the last byte, the rules whose last
place is set fit the whole canonical URL.

A glob is matched against the whole canonical URL, which is ``.`` + host + path
+ query: ``*`` is any run without ``/`` and ``?``, ``**`` any run, ``?`` one
character other than ``/``; a backslash takes the next character as it is. So
``*.example.org/es/**`` is the folder ``/es/`` of a host and all its subdomains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import bytes_of, ship_code, slices

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows advanced together; with W words of rules a block's state is 8 * W times this.
BLOCK_ROWS = 1 << 15


@dataclass(frozen=True)
class Rule:
    """A glob with its verdict. Rules of a name (sites) come before all others."""

    verdict: str
    glob: str
    name: str | None = None

    @property
    def length(self) -> int:
        """What makes one rule longer than another: its name, else its letters."""
        return len(self.name) if self.name is not None else sum(len(x) for x in parse(self.glob) if isinstance(x, bytes))


def site(verdict: str, host: str, path: str) -> Rule:
    """The rule of a host with its subdomains, for paths that begin with ``path``."""
    return Rule(verdict, f"*.{escape(host)}{escape(path)}**", host + path)


def escape(text: str) -> str:
    return re.sub(r"([*?\\])", r"\\\1", text)


# The site rules of the query.
SITES = [
    site("allow", "org", "/"),
    site("block", "example.org", "/es/"),
    site("block", "example.org", "/en/1"),
    site("allow", "com", "/fr/"),
    site("block", "com", "/de/"),
]

# What decides where no site rule does: hosts and pages that are seldom prose.
GLOBS = [
    *(Rule("block", f"*.{label}-**") for label in ("ads", "adult", "casino", "cheap", "free", "spam", "track")),
    *(Rule("block", f"*-{label}.**") for label in ("bets", "casino", "farm", "pills", "track", "win")),
    *(Rule("block", f"**/{folder}/**") for folder in ("cart", "checkout", "login", "signup", "wp-admin")),
    Rule("block", "**/wp-login.php**"),
    Rule("block", "**\\?*replytocom=**"),
    Rule("block", "**\\?*sessionid=**"),
    Rule("block", "**.jpg"),
    Rule("block", "**.zip"),
    Rule("allow", "*.free-software.**"),
]

ANY, SEGMENT, ONE = "**", "*", "?"


def parse(glob: str) -> list:
    """A glob as letters (one byte each) and wildcards."""
    out: list = []
    at = 0
    while at < len(glob):
        if glob.startswith("**", at):
            out.append(ANY)
            at += 2
        elif glob[at] in "*?":
            out.append(glob[at])
            at += 1
        else:
            at += glob[at] == "\\" and at + 1 < len(glob)
            out += [bytes([b]) for b in glob[at].encode()]
            at += 1
    return out


def regex_of(glob: str) -> str:
    """The same glob as a regular expression for a whole canonical URL."""
    found = {ANY: ".*", SEGMENT: "[^/?]*", ONE: "[^/]"}
    out, letters = "", b""
    for part in [*parse(glob), None]:
        if isinstance(part, bytes):
            letters += part
            continue
        out += re.escape(letters.decode())
        letters = b""
        out += found.get(part, "")
    return f"(?s)^{out}$"


class Automaton:
    """Masks of packed globs: ``follow`` and ``stay`` by byte, ``begin``, and each glob's last place."""

    def __init__(self, globs: Sequence[str]):
        places = [parse(g) for g in globs]
        sizes = [1 + sum(x not in (ANY, SEGMENT) for x in p) for p in places]
        words = max(1, -(-sum(sizes) // 64))
        # Bits are laid out plainly first, then packed 64 to a word.
        follow, stay = np.zeros((256, words * 64), bool), np.zeros((256, words * 64), bool)
        begin = np.zeros(words * 64, bool)
        segment = np.ones(256, bool)
        segment[[ord("/"), ord("?")]] = False
        continued = np.zeros(256, bool)
        continued[0x80:0xC0] = True
        one = ~continued
        one[ord("/")] = False
        self.last = np.cumsum(sizes, dtype=np.int64) - 1
        for first, parts in zip(self.last + 1 - sizes, places):
            place = int(first)
            begin[place] = True
            for part in parts:
                if part == ANY:
                    stay[:, place] = True
                elif part == SEGMENT:
                    stay[:, place] |= segment
                else:
                    place += 1
                    if part == ONE:
                        # A character's first byte moves on, its other bytes stay.
                        follow[one, place] = True
                        stay[continued, place] = True
                    else:
                        follow[part[0], place] = True
        self.follow, self.stay, self.begin = (self._pack(x) for x in (follow, stay, begin[None]))

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x globs: which globs fit each text of ``data`` as a whole."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, sizes = offsets[:-1][order], lengths[order]
        state = np.repeat(self.begin, len(order), axis=0)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        for step, n in enumerate(alive.tolist()):
            byte = data[starts[:n] + step]
            old = state[:n]
            moved = old << np.uint64(1)
            moved[:, 1:] |= old[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.follow[byte]) | (old & self.stay[byte])
        fits = (state[:, self.last // 64] >> (self.last % 64).astype(np.uint64)) & np.uint64(1)
        out = np.zeros(fits.shape, bool)
        out[order] = fits.astype(bool)
        return out


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z in lower case), path and query (with its ``?``) of a URL; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    return host, path, query


def canonical_of(url: Column) -> Column:
    host, path, query = url_parts(url)
    return F.concat(F.lit("."), host, path, query)


def _ordered(rules: Sequence[Rule] | None) -> list[Rule]:
    """The first rule that fits decides: sites, longer ones, blocks, then by pattern."""
    rules = SITES + GLOBS if rules is None else rules
    return sorted(rules, key=lambda r: (r.name is None, -r.length, r.verdict != "block", r.glob))


def _deciding(batches: Iterator[pa.RecordBatch], globs: list[str], column: str):
    """Blocks of rows, and for each row the place of the first glob that fits (or their number)."""
    automaton = Automaton(globs)
    for batch in slices(batches, column):
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            rows = batch.slice(at, BLOCK_ROWS)
            fits = automaton.run(*bytes_of(rows.column(column)))
            yield rows, np.column_stack([fits, np.ones(len(fits), bool)]).argmax(1)


def filter_urls(pages: DataFrame, rules: Sequence[Rule] | None = None, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, pattern and verdict of every row's url.

    Of the named rules (sites) that fit, the longest decides and ``rule`` has its
    name; else the longest of the other globs, and ``rule`` is null; else
    ``default``. ``pattern`` is the glob that decided, null for the default. Of
    rules of one length a block goes before an allow.

    A null url, and one without ``://``, has an empty host and path, and is judged
    as such. Repeated rows stay; an empty table gives no rows; columns other than
    page_id and url are not read. A URL of any length is matched whole.
    """
    ship_code(pages.sparkSession)
    order = _ordered(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([r.name for r in order] + [None], pa.string())
        globs = pa.array([r.glob for r in order] + [None], pa.string())
        verdicts = pa.array([r.verdict for r in order] + [default], pa.string())
        for rows, first in _deciding(batches, [r.glob for r in order], "canonical"):
            kept = [rows.column(c) for c in ("page_id", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*kept, names.take(pa.array(first)), globs.take(pa.array(first)), verdicts.take(pa.array(first))],
                ["page_id", "host", "path", "rule", "pattern", "verdict"],
            )

    host, path, _ = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), canonical_of(F.col("url")).alias("canonical"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(
        judge, f"page_id {id_type}, host STRING, path STRING, rule STRING, pattern STRING, verdict STRING"
    )


def keep_allowed(pages: DataFrame, rules: Sequence[Rule] | None = None, default: str = "allow") -> DataFrame:
    """The rows of ``pages``, with all their columns, whose url is not blocked."""
    ship_code(pages.sparkSession)
    order, names = _ordered(rules), pages.columns
    helper = "canonical"
    while helper.lower() in {c.lower() for c in names}:
        helper += "_"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.array([r.verdict != "block" for r in order] + [default != "block"])
        for rows, first in _deciding(batches, [r.glob for r in order], helper):
            yield rows.filter(pa.array(kept[first])).select(names)

    return pages.withColumn(helper, canonical_of(F.col("url"))).mapInArrow(keep, pages.schema)


def oracle(rules: Sequence[Rule] | None = None, default: str = "allow") -> str:
    """SQL that judges ``pages`` with the same rules, as regular expressions."""
    order = _ordered(rules)

    def text(value):
        return "NULL" if value is None else "'" + value.replace("'", "''") + "'"

    def case(value_of, otherwise):
        found = " ".join(f"WHEN regexp_matches(canonical, {text(regex_of(r.glob))}) THEN {text(value_of(r))}" for r in order)
        return f"CASE {found} ELSE {text(otherwise)} END"

    return f"""
        WITH rests AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1) AS query
            FROM rests
        ), canonicals AS (SELECT page_id, host, path, '.' || host || path || query AS canonical FROM parts)
        SELECT page_id, host, path, {case(lambda r: r.name, None)} AS rule, {case(lambda r: r.glob, None)} AS pattern,
            {case(lambda r: r.verdict, default)} AS verdict
        FROM canonicals
    """

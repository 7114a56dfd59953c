"""Path census of XML files that many tasks scan together.

The text source cuts a file at every ``>`` and deals its byte ranges out, so a task sees the tags of a range in order but doesn't know what
is open where the range begins. It counts paths relative to that: each count carries how many elements of the unknown stack had been
closed, and the range reports what it closes and what it leaves open. These reports are a few rows a range. Folding them in
file order gives the stack at every range's beginning, and with it the paths.

A range may also begin inside a comment, a CDATA section, a processing instruction, a document type or an attribute value
with a ``>`` in it. For each of these a further walk starts where such a thing would end; the fold picks the one that the range before
calls for. An attribute value can't hold ``<``, so that walk ends or fails at once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable

#: What ends a state, as the end of a token without its ``>``; the plain state is "".
ENDS = {"comment": "--", "cdata": "]]", "instruction": "?", "doctype": "]"}
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*')""", re.S)
QUOTED = re.compile(r""""[^"]*"|'[^']*'""", re.S)
WALKS = "file long, start long, given string, pops array<string>, opens array<string>, state string, rest string, tail string, bad boolean, up int, rel string, n long"
FOLDED = "file long, start long, given string, base array<string>, path string, n long"


def local(name: str) -> str:
    return name.rpartition(":")[2]


def open_quote(tag: str) -> str:
    """The quote whose attribute value a tag's text ends in, if any."""
    left = QUOTED.sub("", tag)
    return next((c for c in left if c in "\"'"), "")


class Walk:
    """A walk over the tags of a range from a given state."""

    def __init__(self, max_depth: int):
        self.max_depth, self.state, self.rest = max_depth, "", ""
        self.pops: list[str] = []
        self.stack: list[str] = []
        self.counts: Counter = Counter()
        self.bad = False

    def token(self, s: str) -> None:
        if self.state == "tag":
            self.tag(self.rest + ">" + s)
        elif self.state:
            if s.rstrip().endswith(ENDS[self.state]) if self.state == "doctype" else s.endswith(ENDS[self.state]):
                self.state = ""
        else:
            at = s.find("<")
            if at >= 0:
                self.tag(s[at + 1 :])

    def tag(self, t: str) -> None:
        self.state = ""
        if t.startswith("!--"):
            self.state = "" if t.endswith("--") and len(t) >= 5 else "comment"
        elif t.startswith("![CDATA["):
            self.state = "" if t.endswith("]]") else "cdata"
        elif t.startswith("?"):
            self.state = "" if t.endswith("?") and len(t) > 1 else "instruction"
        elif t.startswith("!"):
            self.state = "doctype" if "[" in t and not t.rstrip().endswith("]") else ""
        elif t.startswith("/"):
            name = local(t[1:].strip())
            if self.stack:
                self.bad |= self.stack.pop() != name
            else:
                self.pops.append(name)
        elif open_quote(t):
            self.state, self.rest = "tag", t
        else:
            self.element(t)

    def element(self, t: str) -> None:
        shut = t.endswith("/")
        parts = t.rstrip("/").split(None, 1)
        if not parts:
            self.bad = True
            return
        name = local(parts[0])
        self.stack.append(name)
        if len(self.stack) <= self.max_depth:
            rel = "/".join(self.stack)
            self.counts[len(self.pops), rel] += 1
            for a, _ in ATTRIBUTE.findall(parts[1] if len(parts) > 1 else ""):
                if a != "xmlns" and not a.startswith("xmlns:"):
                    self.counts[len(self.pops), f"{rel}/@{local(a)}"] += 1
        if shut:
            self.stack.pop()


class Range:
    """The walks of one byte range of a file: the plain one, and one for each other state that it may begin in."""

    def __init__(self, file: int, start: int, max_depth: int):
        self.file, self.start, self.max_depth = file, start, max_depth
        self.walks: dict[str, Walk] = {"": Walk(max_depth)}
        self.tails = {q: "" for q in ('"', "'")}
        self.waiting = set(ENDS)
        self.value = {'"', "'"}

    def token(self, s: str) -> None:
        for w in self.walks.values():
            w.token(s)
        for state in [k for k in self.waiting if (s.rstrip() if k == "doctype" else s).endswith(ENDS[k])]:
            self.waiting.discard(state)
            self.walks[state] = Walk(self.max_depth)
        for q in list(self.value):
            self.tails[q] += (">" if self.tails[q] else "") + s
            inside, _, behind = self.tails[q].partition(q)
            if "<" in inside:
                self.value.discard(q)
            elif q in self.tails[q] and not open_quote(behind):
                self.value.discard(q)
                self.walks[q] = Walk(self.max_depth)

    def rows(self) -> Iterator[tuple]:
        for given, w in self.walks.items():
            head = (self.file, self.start, given)
            yield (*head, w.pops, w.stack, w.state, w.rest if w.state == "tag" else None, self.tails.get(given), w.bad, None, None, None)
            for (up, rel), n in w.counts.items():
                yield (*head, None, None, None, None, None, None, up, rel, n)
        # a range that lies inside one such thing
        for state in self.waiting:
            yield (self.file, self.start, state, [], [], state, None, None, False, None, None, None)
        for q in self.value:
            yield (self.file, self.start, q, [], [], "tag", "", self.tails[q], False, None, None, None)


def _scan(max_depth: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split(" ")[0] for c in WALKS.split(", ")]
        now = None
        for pdf in batches:
            for file, start, s in zip(pdf["file"].tolist(), pdf["start"].tolist(), pdf["value"].tolist(), strict=True):
                if now is None or (now.file, now.start) != (file, start):
                    if now is not None:
                        yield pd.DataFrame(list(now.rows()), columns=names)
                    now = Range(file, start, max_depth)
                now.token(s)
        if now is not None:
            yield pd.DataFrame(list(now.rows()), columns=names)

    return run


def _fold(max_depth: int):
    """The stack at the beginning of each range of a file, from a few rows a range."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        by: dict[int, dict[str, object]] = {}
        for r in pdf.itertuples():
            by.setdefault(r.start, {})[r.given] = r
        stack, state, rest, out = [], "", None, []
        for start in sorted(by):
            head = Walk(max_depth)
            head.stack = list(stack)
            if state == "tag":  # finish the tag that the range before began
                given = open_quote(rest)
                if given not in by[start]:
                    raise ValueError("a tag doesn't end")
                rest += ">" + by[start][given].tail
                if by[start][given].rest == "" and by[start][given].state == "tag":
                    continue
                head.tag(rest)
                out += [(int(pdf["file"].iat[0]), start, given, [], f"/{rel}", n) for (_, rel), n in head.counts.items()]
                stack = head.stack
            else:
                given = state
            r = by[start][given]
            pops = list(r.pops)
            if r.bad or len(pops) > len(stack) or pops != stack[::-1][: len(pops)]:
                raise ValueError("elements aren't nested")
            out.append((r.file, start, given, stack, None, None))
            stack = stack[: len(stack) - len(pops)] + list(r.opens)
            state, rest = r.state, r.rest
        if stack or state:
            raise ValueError("a file ends inside an element")
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in FOLDED.split(", ")])

    return run


def path_census(spark: SparkSession, path: str, max_depth: int = 8) -> DataFrame:
    """(path, n): how often each element and attribute path occurs in the XML files under a path, to a depth.

    Files are UTF-8 and not compressed as a whole, else Spark can't deal out their ranges. Names are local names; namespace declarations aren't
    attributes. A file may hold several root elements or none. Elements that aren't nested are an error.
    """
    tokens = spark.read.option("lineSep", ">").text(path).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    walked = durable(tokens.mapInPandas(_scan(max_depth), WALKS), "census")
    reports = walked.where("opens IS NOT NULL").drop("up", "rel", "n")
    folded = durable(reports.groupBy("file").applyInPandas(_fold(max_depth), FOLDED), "census-stacks")
    counts = walked.where("n IS NOT NULL").select("file", "start", "given", "up", "rel", "n")
    placed = counts.join(folded.where("n IS NULL").select("file", "start", "given", "base"), ["file", "start", "given"])
    above = F.slice("base", F.lit(1), F.size("base") - F.col("up"))
    full = F.concat(F.lit("/"), F.array_join(F.concat(above, F.array("rel")), "/"))
    paths = placed.select(full.alias("path"), "n").unionByName(folded.where("n IS NOT NULL").select("path", "n"))
    depth = F.size(F.split("path", "/")) - 1 - F.contains("path", F.lit("/@")).cast("int")
    return paths.where(depth <= max_depth).groupBy("path").agg(F.sum("n").alias("n"))

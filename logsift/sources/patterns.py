"""The pattern catalogue: named regular expressions tested against each
cleaned log line.

A catalogue is a list of ``Pattern(regex_id, pattern)``. It is configuration
(tens of entries), so it lives on the driver and is compiled into the plan as
literal expressions; it is never a data-sized input. ``from_frame`` accepts a
catalogue held as a table, after checking its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# FIXED VALUES: the default catalogue, in catalogue order. Ids and patterns
# must stay exactly as they are for results to equal the reference.
DEFAULT_PATTERNS = [
    ("LOG_TYPE_ERROR", r"\[ERROR\]"),
    ("LOG_TYPE_WARNING", r"\[WARNING\]"),
    ("LOG_TYPE_INFO", r"\[INFO\]"),
    ("LOG_TYPE_DEBUG", r"\[DEBUG\]"),
    ("ERROR_DETAIL_NPE", r"NullPointerException"),
    ("ERROR_DETAIL_OOM", r"OutOfMemoryError"),
    ("ERROR_DETAIL_FILE_NOT_FOUND", r"FileNotFoundException"),
    ("ERROR_DETAIL_CONN_REFUSED", r"ConnectionRefused"),
    ("ERROR_DETAIL_TIMEOUT", r"Timeout waiting for response"),
    ("WARNING_DETAIL_CONN_TIMEOUT", r"Connection attempt timed out"),
    ("WARNING_DETAIL_RETRY", r"Retrying operation"),
    ("WARNING_DETAIL_SLOW_QUERY", r"Slow query detected"),
    ("WARNING_DETAIL_LOW_MEMORY", r"Low memory warning"),
    ("WARNING_DETAIL_DEPRECATED", r"Warning: deprecated method used"),
    ("USER_LOGIN_SUCCESS", r"User logged in"),
    ("PAGE_VIEWED", r"Page viewed"),
    ("REQUEST_PROCESSED", r"Request processed successfully"),
    ("DATA_SAVED", r"Data saved"),
    ("OPERATION_COMPLETED", r"Operation completed"),
    ("ADDITIONAL_INFO_LINE", r"^\s+Additional info: request_id=([a-f0-9]{10}), process_time=(\d+)ms$"),
    ("USER_ID_EXTRACT", r"user_id=(\w+)"),
    ("SESSION_ID_EXTRACT", r"session_id=(\w+)"),
    ("IP_ADDRESS_EXTRACT", r"from IP (\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"),
]

# FIXED VALUES: names of the capture groups of the default patterns, in order.
DEFAULT_FIELDS = {
    "ADDITIONAL_INFO_LINE": ("request_id", "process_time"),
    "USER_ID_EXTRACT": ("user_id",),
    "SESSION_ID_EXTRACT": ("session_id",),
    "IP_ADDRESS_EXTRACT": ("ip_address",),
}

# The id that marks error lines (the store's error view filters on it).
ERROR_REGEX_ID = "LOG_TYPE_ERROR"

# Column limit of regex_id in the result store.
MAX_REGEX_ID_LENGTH = 50


_META = set(".^$*+?{}[]()|\\")


@dataclass(frozen=True)
class Pattern:
    regex_id: str
    pattern: str
    # Names of the capture groups; empty: as the pattern itself names them.
    fields: tuple[str, ...] = ()

    def group_names(self) -> list[str]:
        """A name for each capture group, in order: the given ones, else the
        pattern's own ``(?<name>...)``, else ``group_<n>``."""
        own = []
        i, p = 0, self.pattern
        in_class = 0
        while i < len(p):
            if p.startswith("\\Q", i):  # quoted text
                end = p.find("\\E", i)
                i = len(p) if end < 0 else end + 2
                continue
            if p[i] == "\\":
                i += 2
                continue
            if p[i] == "[":
                in_class += 1
            elif p[i] == "]" and in_class:
                in_class -= 1
            elif p[i] == "(" and not in_class:
                if not p.startswith("(?", i):
                    own.append("")
                elif p.startswith("(?<", i) and p[i + 3 : i + 4] not in ("=", "!"):
                    own.append(p[i + 3 : p.index(">", i)])
            i += 1
        given = [*self.fields, *[""] * len(own)]
        return [given[k] or name or f"group_{k + 1}" for k, name in enumerate(own)]

    def literal(self) -> str | None:
        """The plain text this pattern searches for, or None when it needs a
        regex engine. ``\\[ERROR\\]`` is the literal ``[ERROR]``."""
        out = []
        i, p = 0, self.pattern
        while i < len(p):
            ch = p[i]
            if ch == "\\":
                # A backslash before an ASCII non-alphanumeric character
                # stands for that character itself.
                if i + 1 < len(p) and p[i + 1].isascii() and not p[i + 1].isalnum():
                    out.append(p[i + 1])
                    i += 2
                    continue
                return None
            if ch in _META:
                return None
            out.append(ch)
            i += 1
        return "".join(out) if out else None


    def required_literal(self) -> str | None:
        """The longest text every match must contain, or None. Used as a
        cheap ``contains`` test before the regex runs: ``user_id=(\\w+)``
        needs ``user_id=``. Conservative: alternation, inline flags and
        escapes that stand for more than one character give None."""
        p = self.pattern
        if "(?" in p or "\\Q" in p:
            return None
        runs, cur = [], []
        i, depth = 0, 0

        def cut():
            if cur:
                runs.append("".join(cur))
                cur.clear()

        while i < len(p):
            ch = p[i]
            if ch == "\\":
                nxt = p[i + 1] if i + 1 < len(p) else ""
                if nxt.isascii() and nxt and not nxt.isalnum():
                    if depth == 0:
                        cur.append(nxt)
                    i += 2
                    continue
                if nxt in "xuc0pPkNQE" or not nxt or nxt.isdigit():
                    return None
                cut()  # a class (\\d, \\s, ...) or an anchor (\\b)
                i += 2
                continue
            if ch == "[":
                cut()
                j = i + 1
                if j < len(p) and p[j] == "^":
                    j += 1
                if j < len(p) and p[j] == "]":
                    j += 1
                while j < len(p) and p[j] != "]":
                    if p[j] == "[" or p.startswith("&&", j):
                        return None  # nested or intersected class
                    j += 2 if p[j] == "\\" else 1
                i = j + 1
                continue
            if ch == "(":
                cut()
                depth += 1
                i += 1
                continue
            if ch == ")":
                depth -= 1
                i += 1
                continue
            if ch == "|":
                if depth == 0:
                    return None
                i += 1
                continue
            if ch in "*?{":
                if depth == 0 and cur:
                    cur.pop()  # the quantified character may be absent
                cut()
                if ch == "{":
                    while i < len(p) and p[i] != "}":
                        i += 1
                i += 1
                continue
            if ch == "+":
                cut()
                i += 1
                continue
            if ch in ".^$":
                cut()
                i += 1
                continue
            if depth == 0:
                cur.append(ch)
            else:
                cut()
            i += 1
        cut()
        return max(runs, key=len) if runs else None


class CatalogueError(ValueError):
    pass


def catalogue(entries=None) -> list[Pattern]:
    """Build and validate a catalogue from (id, pattern) pairs or dicts with
    ``regexId``/``pattern`` keys. Defaults to the built-in 23 patterns."""
    if entries is None:
        entries = [Pattern(rid, pat, DEFAULT_FIELDS.get(rid, ())) for rid, pat in DEFAULT_PATTERNS]
    out = []
    for e in entries:
        if isinstance(e, Pattern):
            out.append(e)
        elif isinstance(e, dict):
            out.append(Pattern(e.get("regexId", e.get("regex_id")), e.get("pattern"), tuple(e.get("fields") or ())))
        else:
            rid, pat = e
            out.append(Pattern(rid, pat))
    validate(out)
    return out


def validate(patterns: list[Pattern]) -> None:
    for p in patterns:
        if not p.regex_id:
            raise CatalogueError(f"pattern without an id: {p!r}")
        if len(p.regex_id) > MAX_REGEX_ID_LENGTH:
            raise CatalogueError(f"regex id longer than {MAX_REGEX_ID_LENGTH}: {p.regex_id!r}")
        if p.pattern is None or p.pattern == "":
            raise CatalogueError(f"empty pattern for {p.regex_id!r}")
        if "(?P<" in p.pattern:
            raise CatalogueError(f"named groups (?P<..>) are not Java syntax: {p.regex_id!r}")


def check_java(spark: SparkSession, patterns: list[Pattern]) -> None:
    """Compile every pattern in the JVM up front. Spark only reports a bad
    pattern when a task first evaluates it; this turns that into a load-time
    error with the pattern's id."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # no JVM handle (remote session): Spark reports at run time
        return
    for p in patterns:
        try:
            jvm.java.util.regex.Pattern.compile(p.pattern)
        except Exception as ex:  # py4j wraps PatternSyntaxException
            raise CatalogueError(f"pattern {p.regex_id!r} is not a valid Java regex: {ex}") from ex


def grouped(patterns: list[Pattern]) -> list[tuple[str, list[Pattern]]]:
    """Patterns grouped by id, in order of first appearance.

    Two entries with one id produce one match row per line (the id matches if
    either pattern does), which is what a distinct over the match rows gives.
    """
    order: dict[str, list[Pattern]] = {}
    for p in patterns:
        order.setdefault(p.regex_id, []).append(p)
    return list(order.items())


def from_frame(df: DataFrame, id_col: str = "regexId", pattern_col: str = "pattern") -> list[Pattern]:
    """A catalogue held as a table, in the order of its ``position`` column
    where there is one. The catalogue is compiled into the plan, so all of it
    passes through the driver, whatever its length."""
    if "position" in df.columns:
        df = df.orderBy("position")
    names = ["fields"] if "fields" in df.columns else []
    rows = df.select(id_col, pattern_col, *names).collect()
    return catalogue([Pattern(r[0], r[1], tuple(r[2] or ()) if names else ()) for r in rows])


def to_frame(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    return spark.createDataFrame(
        [(i, p.regex_id, p.pattern, list(p.fields)) for i, p in enumerate(patterns)],
        "position int, regexId string, pattern string, fields array<string>",
    )

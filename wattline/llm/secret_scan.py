"""Secret scan with one combined deterministic automaton (operator 1).

The rules' regexes are parsed into small thread programs. Subset construction
over ordered thread lists (earlier starts first, greedy branches first) gives,
for each rule, the leftmost greedy non-overlapping matches; the product over all
rules is minimised into one transition array over byte classes, whose states
also say which rules' matches have just ended. One pass over the bytes of a
group of texts finds all ends: the buffer is cut after bytes that bring every
state back to the start, and the pieces advance together, a byte a step. Starts
come from the reversed rule, run back from the (rare) ends.

A rule must be able to tell the end of a match from the byte that follows it
(after an accepting byte, each further byte accepts or ends the match); other
rules raise ValueError when compiled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattline.llm.common import id_and_text, map_texts

#: Ends every text in a buffer; it never occurs in UTF-8.
END = 0xFF
#: Least bytes between two cuts of a buffer, and pieces below which the pass goes byte by byte.
STRIDE, FEW = 256, 16


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base rules. Shorter runs of hex digits are left out by the
#: pattern itself, which changes no other match, as most words have letters a to f.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Formats that issuers publish for their own tokens.
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 0, 40),
    Rule("google", r"AIza[A-Za-z0-9_\-]+", 0, 39),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)

# -- rules to thread programs


def _parse(pattern: str):
    """Tree of a pattern: ("set", mask) | ("cat", [..]) | ("alt", [..]) | ("rep", node, low, high)."""
    at = 0

    def peek():
        return pattern[at] if at < len(pattern) else ""

    def escape() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return int(pattern[at - 2:at], 16)
        if c.isalnum():
            raise ValueError(f"\\{c} is not supported in {pattern!r}")
        return ord(c)

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        b = escape() if c == "\\" else ord(c)
        if b > 127:
            raise ValueError("rules are over ASCII")
        return b

    def letters(b: int, fold: bool) -> int:
        return 1 << b | (1 << ord(chr(b).swapcase()) if fold else 0)

    def char_class() -> int:
        nonlocal at
        at += 1
        if peek() == "^":
            raise ValueError("negated classes are not supported")
        mask = 0
        while peek() != "]":
            low = high = char()
            if peek() == "-" and pattern[at + 1] != "]":
                at += 1
                high = char()
            for b in range(low, high + 1):
                mask |= 1 << b
        at += 1
        return mask

    def either(fold: bool):
        nonlocal at
        branches = [sequence(fold)]
        while peek() == "|":
            at += 1
            branches.append(sequence(fold))
        return ("alt", branches) if len(branches) > 1 else branches[0]

    def sequence(fold: bool):
        nonlocal at
        parts = []
        while at < len(pattern) and peek() not in "|)":
            if peek() == "(":
                at += 1
                inner = fold
                for mark, folds in (("?i:", True), ("?:", fold)):
                    if pattern.startswith(mark, at):
                        at, inner = at + len(mark), folds
                        break
                node = either(inner)
                at += 1
            elif peek() == "[":
                node = ("set", char_class())
            elif peek() in ".^$*+?{":
                raise ValueError(f"{peek()!r} is not supported here in {pattern!r}")
            else:
                node = ("set", letters(char(), fold))
            if peek() and peek() in "?*+":
                node = ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[peek()])
                at += 1
            elif peek() == "{":
                close = pattern.index("}", at)
                low, comma, high = pattern[at + 1:close].partition(",")
                node = ("rep", node, int(low), int(high) if high else None if comma else int(low))
                at = close + 1
            parts.append(node)
        return ("cat", parts)

    tree = either(False)
    if at != len(pattern):
        raise ValueError(f"cannot read {pattern!r} at {at}")
    return tree


def _reversed(node):
    if node[0] == "cat":
        return ("cat", [_reversed(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [_reversed(x) for x in node[1]])
    return ("rep", _reversed(node[1]), *node[2:]) if node[0] == "rep" else node


MATCH = -1


class _Program:
    """Instructions: ("set", mask) goes on to the next one, ("split", a, b) prefers a."""

    def __init__(self, tree):
        self.code: list[tuple] = []
        self._emit(tree)
        self.code.append(("match",))
        self._closures: dict[int, tuple[int, ...]] = {}

    def _emit(self, node):
        kind = node[0]
        if kind == "set":
            self.code.append(node)
        elif kind == "cat":
            for x in node[1]:
                self._emit(x)
        elif kind == "alt":
            ends = []
            for x in node[1][:-1]:
                split = len(self.code)
                self.code.append(())
                self._emit(x)
                ends.append(len(self.code))
                self.code.append(())
                self.code[split] = ("split", split + 1, len(self.code))
            self._emit(node[1][-1])
            for e in ends:
                self.code[e] = ("split", len(self.code), len(self.code))
        else:
            _, x, low, high = node
            for _ in range(low):
                self._emit(x)
            if high is None:
                split = len(self.code)
                self.code.append(())
                self._emit(x)
                self.code.append(("split", split, split))
                self.code[split] = ("split", split + 1, len(self.code))
            else:
                splits = []
                for _ in range(high - low):
                    splits.append(len(self.code))
                    self.code.append(())
                    self._emit(x)
                for s in splits:
                    self.code[s] = ("split", s + 1, len(self.code))

    def closure(self, at: int) -> tuple[int, ...]:
        """Where a thread at `at` can read next, in order of preference; MATCH for the end."""
        if at not in self._closures:
            out, seen, todo = [], set(), [at]
            while todo:
                pc = todo.pop()
                if pc in seen:
                    continue
                seen.add(pc)
                op = self.code[pc]
                if op[0] == "split":
                    todo += [op[2], op[1]]
                else:
                    out.append(pc if op[0] == "set" else MATCH)
            self._closures[at] = tuple(out)
        return self._closures[at]

    def reads(self, pc: int, byte: int) -> bool:
        return bool(self.code[pc][1] >> byte & 1)


def _search_dfa(rule: Rule, samples: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(table, ended) of the leftmost greedy search for one rule; state 0 is the start.

    A subset state is (threads in order, whether a match is open, whether one has
    ended before the byte just read).
    """
    program = _Program(_parse(rule.pattern))
    start = (program.closure(0), False, False)
    if MATCH in start[0]:
        raise ValueError(f"{rule.kind} matches an empty text")

    def step(threads, matched, byte):
        new: dict[int, None] = {}
        accepted = False
        for pc in threads:
            if program.reads(pc, byte):
                for q in program.closure(pc + 1):
                    if q == MATCH:  # later starts and lazier branches are out
                        accepted = True
                        break
                    new[q] = None
            if accepted:
                return tuple(new), True, False
        if not matched:
            return tuple(dict.fromkeys([*new, *start[0]])), False, False
        if new:
            raise ValueError(f"the end of a {rule.kind} can only be told by looking back")
        return (*step(start[0], False, byte)[:2], True)

    seen, rows, todo = {start: 0}, [], [start]
    while len(rows) < len(todo):
        row = []
        for byte in samples:
            after = step(*todo[len(rows)][:2], byte)
            if after not in seen:
                seen[after] = len(todo)
                todo.append(after)
            row.append(seen[after])
        rows.append(row)
    return _minimal(np.array(rows), np.array([int(s[2]) for s in todo]))


def _minimal(table: np.ndarray, output: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same automaton with equivalent states merged (partition refinement)."""
    block = np.unique(output, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    first = np.sort(np.unique(block, return_index=True)[1])  # keeps the start first
    number = np.empty(len(first), dtype=np.int64)
    number[block[first]] = np.arange(len(first))
    return number[block[table[first]]], output[first]


def _product(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Reachable product of automata; its output has bit r set where part r's is 1."""
    sizes = [len(t) for t, _ in parts]
    seen, frontier, rows, outputs = {}, np.zeros((1, len(parts)), dtype=np.int64), [], []
    seen[0] = 0
    while len(frontier):
        outputs.append(sum(out[frontier[:, r]].astype(np.int64) << r for r, (_, out) in enumerate(parts)))
        after = np.stack([t[frontier[:, r]] for r, (t, _) in enumerate(parts)], axis=-1)
        key = np.zeros(after.shape[:2], dtype=np.int64)
        for r, size in enumerate(sizes):
            key = key * size + after[..., r]
        keys, first = np.unique(key, return_index=True)
        fresh = [(k, i) for k, i in zip(keys.tolist(), first.tolist(), strict=True) if k not in seen]
        for k, _ in fresh:
            seen[k] = len(seen)
        rows.append(np.array([seen[k] for k in keys.tolist()])[np.searchsorted(keys, key)])
        frontier = after.reshape(-1, len(parts))[[i for _, i in fresh]]
    return np.concatenate(rows), np.concatenate(outputs)


class Automaton:
    """Minimised product of the rules' search automata.

    classes: byte -> class; table: state, class -> next state; ended: state -> bit
    mask of the rules whose match ended before the byte just read. States that report
    an end have the highest numbers, from `first_end` on.
    """

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        programs = [_Program(_parse(r.pattern)) for r in rules]
        masks = sorted({op[1] for p in programs for op in p.code if op[0] == "set"})
        keys = [tuple(m >> b & 1 for m in masks) for b in range(256)]
        number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        self.classes = np.array([number[k] for k in keys], dtype=np.uint8)
        samples = [keys.index(k) for k in number]
        table, ended = _minimal(*_product([_search_dfa(r, samples) for r in rules]))
        order = np.argsort(ended != 0, kind="stable")
        new = np.argsort(order)
        self.table, self.ended, self.start = new[table[order]], ended[order], int(new[0])
        self.first_end = int((self.ended == 0).sum())
        same = np.unique(self.table, axis=0, return_inverse=True)[1].reshape(-1)
        self.resets = (same[self.table] == same[self.start]).all(axis=0)
        if not self.resets[self.classes[END]]:
            raise ValueError("a rule reads the byte that ends a text")
        self.n_classes = len(samples)
        self.flat = (self.table * self.n_classes).astype(np.int32).reshape(-1)
        self.backward = [_Program(_reversed(_parse(r.pattern))) for r in rules]
        self.steps_back: dict = {}
        self.patterns = [re.compile(r.pattern) for r in rules]

    def ends(self, buffer: np.ndarray) -> list[tuple[int, int]]:
        """(position of the byte after a match, mask of rules), unordered; the buffer ends with END."""
        cls = self.classes[buffer]
        cut = np.flatnonzero(self.resets[cls])
        cut = cut[np.append(True, np.diff(cut // STRIDE) > 0)] if len(cut) else cut
        stop = np.unique(np.append(cut + 1, len(buffer)))
        begin = np.append(0, stop[:-1])
        order = np.argsort(begin - stop, kind="stable")
        begin, size = begin[order], (stop - begin)[order]
        state = np.full(len(begin), self.start * self.n_classes, dtype=np.int32)
        low, found, alive = self.first_end * self.n_classes, [], len(begin)
        for j in range(int(size[0]) if len(size) else 0):
            while alive and size[alive - 1] <= j:
                alive -= 1
            if alive < FEW:
                for lane in range(alive):
                    self._one(cls, int(begin[lane]) + j, int(begin[lane] + size[lane]), int(state[lane]), found)
                break
            now = self.flat.take(state[:alive] + cls.take(begin[:alive] + j))
            state[:alive] = now
            for lane in np.flatnonzero(now >= low).tolist():
                found.append((int(begin[lane]) + j, int(self.ended[now[lane] // self.n_classes])))
        return found

    def _one(self, cls: np.ndarray, at: int, stop: int, state: int, found: list) -> None:
        flat, low = self.flat.tolist() if stop - at > 1 << 16 else self.flat, self.first_end * self.n_classes
        for i, c in enumerate(cls[at:stop].tolist(), at):
            state = flat[state + c]
            if state >= low:
                found.append((i, int(self.ended[state // self.n_classes])))

    def begin(self, rule: int, data: bytes, bound: int, end: int) -> int:
        """Least start >= bound of a match of the rule that ends at `end`."""
        program = self.backward[rule]
        threads = frozenset(program.closure(0))
        found, at = end, end
        while threads and at > bound:
            at -= 1
            key = (rule, threads, data[at])
            if key not in self.steps_back:
                self.steps_back[key] = frozenset(q for pc in threads if pc != MATCH and program.reads(pc, data[at]) for q in program.closure(pc + 1))
            threads = self.steps_back[key]
            if MATCH in threads:
                found = at
        return found

    def scan(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Per text, (kind, start, end) in code points, by start, then in the rules' order."""
        data = [t.encode() for t in texts]
        joined = b"".join(d + bytes([END]) for d in data)
        bounds = np.cumsum([0, *(len(d) + 1 for d in data)])
        out: list[list] = [[] for _ in texts]
        by_text: dict[int, list] = {}
        if texts:
            ends = sorted(self.ends(np.frombuffer(joined, dtype=np.uint8)))
            owners = np.searchsorted(bounds, [p for p, _ in ends], side="right") - 1
            for (p, mask), k in zip(ends, owners.tolist(), strict=True):
                by_text.setdefault(k, []).append((p - int(bounds[k]), mask))
        for k, found in by_text.items():
            raw, last, spans = data[k], [0] * len(self.rules), []
            point = None
            if not raw.isascii():  # code point at each byte
                point = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
                point = np.append(0, point)
            for end, mask in found:
                for r, rule in enumerate(self.rules):
                    if not mask >> r & 1:
                        continue
                    start, last[r] = self.begin(r, raw, last[r], end), end
                    m = self.patterns[r].fullmatch(raw[start:end].decode())
                    if m and len(m[rule.group]) >= rule.least:
                        s, e = (start, end) if point is None else (int(point[start]), int(point[end]))
                        spans.append((s, r, e))
            out[k] = [(self.rules[r].kind, s, e) for s, r, e in sorted(spans)]
        return out


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    """Compiled once on the driver and broadcast."""
    return Automaton(rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every whole text; spans is an array of (kind, start, end)
    in code points, end exclusive, by start, then in the rules' order. Matches of
    one rule don't overlap; those of different rules may.

    A null or empty text has no spans; repeated rows and null ids are scanned row
    by row; an empty table gives no rows; columns other than the two named are
    ignored, whatever their names.
    """
    compiled = docs.sparkSession.sparkContext.broadcast(automaton(rules))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def per_group(texts):
        rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in compiled.value.scan(texts)]
        return {"spans": pa.array(rows, kind)}

    return map_texts(id_and_text(docs, id_col, text_col), per_group, "spans array<struct<kind:string,start:long,end:long>>")

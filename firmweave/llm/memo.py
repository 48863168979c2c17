"""Results for strings seen before, in bounded memory."""

from __future__ import annotations

import weakref
from collections.abc import Callable

_ALL: weakref.WeakSet = weakref.WeakSet()


def forget(but: str | None = None) -> None:
    """Empty this worker's memos, but for those of one group: workers live on from one operator to the next."""
    for memo in list(_ALL):
        if memo.group != but and (memo.young or memo.old):
            memo.young, memo.old = {}, {}


class Memo:
    """Two generations: when the young one is full it becomes the old one; what is used again moves back. So frequent
    strings stay, and at most ``size`` are held beside those of the current call. Only memos of one ``group`` hold anything at a time."""

    def __init__(self, size: int, longest: int = 64, group: str = ""):
        self.size, self.longest, self.group = size, longest, group
        _ALL.add(self)
        self.young: dict = {}
        self.old: dict = {}

    def lookup(self, strings: set[str], compute: Callable[[list[str]], list]) -> dict:
        """A mapping that holds all of ``strings``; ``compute`` gives the values of new ones. Valid until the next call."""
        if not self.young:
            forget(but=self.group)
        if len(self.young) > self.size // 2:
            self.old, self.young = self.young, {}
        # One look for each string: set differences with a dictionary would walk through all of it.
        missing = []
        for string in [s for s in strings if s not in self.young]:
            if string in self.old:
                self.young[string] = self.old.pop(string)
            else:
                missing.append(string)
        found = dict(zip(missing, compute(missing), strict=True)) if missing else {}
        if any(len(s) > self.longest for s in missing):
            once = {s: v for s, v in found.items() if len(s) > self.longest}
            self.young.update((s, v) for s, v in found.items() if s not in once)
            return _Both(self.young, once)
        self.young.update(found)
        return self.young


class _Both(dict):
    """Looks up long strings first, which are not kept."""

    def __init__(self, kept: dict, once: dict):
        super().__init__(once)
        self.kept = kept

    def __missing__(self, string: str):
        return self.kept[string]

"""Registries: named callables, and the table of checkable queries with their SQL twins."""

from __future__ import annotations

import json
import logging
import pathlib
import re
import runpy
from collections.abc import Callable

from . import relations


class Registry:
    """Callables by name; a name is taken once unless ``force`` is set."""

    def __init__(self, kind: str):
        self.kind, self._items = kind, {}

    def register(self, name: str, force: bool = False):
        def put(item):
            if name in self._items and not force:
                raise KeyError(f"{name} is a {self.kind} already")
            self._items[name] = item
            return item

        return put

    def get(self, name: str):
        if name not in self._items:
            raise KeyError(f"no {self.kind} named {name}; there are {', '.join(sorted(self._items))}")
        return self._items[name]

    def names(self) -> list[str]:
        return sorted(self._items)

    def build(self, config: dict, **more):
        """config: {"type": name, option: value...}."""
        options = {k: v for k, v in config.items() if k != "type"} | more
        return self.get(config["type"])(**options)


QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers f(spark, sf_dir) -> DataFrame, with SQL over the relations of ``relations`` where there is any."""

    def put(f):
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = relations.with_relations(sql)
        return f

    return put


def option_overrides(text: str) -> dict:
    """``a.b=1,c.d 2`` -> {"a.b": 1.0, "c.d": 2.0}; values that are numbers become floats."""
    out: dict = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        key, value = re.split(r"[= ]", part, maxsplit=1)
        try:
            out[key] = float(value)
        except ValueError:
            out[key] = value
    return out


def merge_config(base: dict, own: dict, known_only: bool = False, warn: bool = False) -> dict:
    """own over base, nested dictionaries key by key. A key that base lacks is an error with known_only, and logged with
    warn; a dictionary can't take the place of a plain value then."""
    out = dict(base)
    for k, v in own.items():
        if k not in base:
            if known_only:
                raise KeyError(f"unknown option {k}")
            if warn:
                logging.getLogger(__name__).warning("option without a default: %s", k)
        elif warn and isinstance(v, dict) and not isinstance(base[k], dict):
            raise TypeError(f"option {k} is a plain value in the base")
        out[k] = merge_config(base[k], v, known_only, warn) if isinstance(v, dict) and isinstance(base.get(k), dict) else v
    return out


#: The option that names the files a configuration builds on, relative to its own.
BASES = "_base_config_"


def load_config(path: str) -> dict:
    """Options of a JSON file or of the variables of a Python file, over those of its bases, which share no key."""
    at = pathlib.Path(path)
    if at.suffix == ".json":
        own = json.loads(at.read_text())
    elif at.suffix == ".py":
        own = {k: v for k, v in runpy.run_path(str(at)).items() if not k.startswith("__")}
    else:
        raise ValueError(f"{path} is neither a JSON nor a Python file")
    named = own.pop(BASES, None)
    if named is None:
        return own
    base: dict = {}
    for name in [named] if isinstance(named, str) else named:
        more = load_config(str(at.parent / name))
        if twice := base.keys() & more.keys():
            raise KeyError(f"more than one base has {', '.join(sorted(twice))}")
        base |= more
    return merge_config(base, own, warn=True)


def apply_overrides(config: dict, text: str) -> dict:
    out = dict(config)
    for path, value in option_overrides(text).items():
        nested: dict = {}
        at = nested
        *parents, last = path.split(".")
        for p in parents:
            at = at.setdefault(p, {})
        at[last] = value
        out = merge_config(out, nested)
    return out

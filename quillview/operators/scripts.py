"""What scripted operations do to the arrays of a document.

A table comment can name a script for additions to an array and one for removals. A script is declared by
its effect, so that the fold stays set operations: which object of a key stays, where a key's place is, and
whether members make an array or an object by key. All additions to one array go by one script. An
operation without a script is an error.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from quillview.config import Config, ConfigError


@dataclass(frozen=True)
class Script:
    adds: bool = True
    value: str = "last"  # or "first": an object whose key is there already is ignored
    place: str = "first"  # or "last": a key that is added again goes to the end
    shape: str = "array"  # or "map": objects by key

    def __post_init__(self) -> None:
        if {self.value, self.place} - {"first", "last"} or self.shape not in ("array", "map"):
            raise ValueError(f"not the effect of a script: {self}")


ARRAYS: Mapping[str, Script] = {"inline_add": Script(), "inline_del": Script(adds=False)}
STANDARD: Mapping[str, Script] = {**ARRAYS, "inline_add_map": Script(shape="map")}


def named(scripts: Mapping[str, Script], **effect: object) -> list[str]:
    """Names of the scripts that have an effect."""
    return [n for n, s in scripts.items() if all(getattr(s, k) == v for k, v in effect.items())]


def of_config(config: Config, registry: Mapping[str, Script] = STANDARD) -> dict[str, Script]:
    """The standard scripts and those that the arrays of a config name."""
    found = dict(ARRAYS)
    for i in (i for t in config.tables.values() for i in t.inlines):
        for name, adds in ((i.add, True), (i.remove, False)):
            script = registry.get(name)
            if script is None:
                raise ConfigError(f"inline {i.name} names the script {name!r}, whose effect is not declared")
            if script.adds != adds:
                raise ConfigError(f"inline {i.name} names the script {name!r} for {'additions' if adds else 'removals'}, which is not its effect")
            found[name] = script
    return found

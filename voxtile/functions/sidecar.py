"""Descriptions of table columns, resolved from the parts of their names."""

from __future__ import annotations

import re

# The words of the descriptions.  Each rule has a name and a text; the second text is for a base without one.
AGGREGATES = ("mean", "std", "min", "max")
OF_STAIN = ("{name} ({stain})", "{text} Stain/channel: {stain}.", "Metric '{base}' for stain/channel '{stain}'.")
OF_TEST = ("{name} – {kind}", "{kind_text} for metric '{base}'.")
OF_TEST_IN_GROUP = ("{name} – {kind} (group: {group})", "{kind_text} for metric '{base}', group '{group}'.")
OF_AGGREGATE = ("{name} – {kind}", "{kind} of: {text}", "{kind} of '{base}'.")
OF_AGGREGATE_IN_GROUP = ("{name} – {kind} (group: {group})", "{kind} of: {text} Group: {group}.", "{kind} of '{base}' for group '{group}'.")
OF_SUBJECTS = ("Number of subjects", "Total number of subjects contributing data to this row.")
OF_SUBJECTS_IN_GROUP = ("Number of subjects (group: {group})", "Number of subjects in group '{group}' contributing data to this row.")


def _entry(words: tuple[str, ...], known: dict, /, **values: str) -> dict:
    """LongName and Description by the words of a rule."""
    values |= {"name": known.get("LongName", values.get("base", "")), "text": known.get("Description", "")}
    text = words[1] if values["text"] or len(words) == 2 else words[2]
    return {"LongName": words[0].format(**values), "Description": text.format(**values)}


def describe_column(name: str, known: dict[str, dict], tests: tuple[str, ...] = ()) -> dict:
    """Description of a column, by the first rule that applies.

    1. its exact name; 2. ``{stain}+{metric}``: what is known of the metric, with the stain; 3. ``{base}_{test}`` and
    ``{base}_{test}_{group}`` for the test statistics; 4. the same for mean, std, min and max, with the base's units;
    5. ``n_subjects`` and ``n_{group}``; 6. nothing.  A group may hold underscores; of two readings the one with the longest base counts.
    """
    if name in known:
        return dict(known[name])
    stain, plus, metric = name.partition("+")
    if plus:
        base = describe_column(metric, known, tests)
        return base | _entry(OF_STAIN, base, base=metric, stain=stain)
    for kind in (*tests, *AGGREGATES):
        for pattern in (rf"(?P<base>.+)_{re.escape(kind)}_(?P<group>.+)", rf"(?P<base>.+)_{re.escape(kind)}"):
            if m := re.fullmatch(pattern, name):
                base, values = describe_column(m["base"], known, tests), m.groupdict()
                if kind in tests:
                    own = known.get(kind, {})
                    title = own.get("LongName", kind)
                    return _entry(OF_TEST_IN_GROUP if "group" in values else OF_TEST, base, kind=title, kind_text=own.get("Description", title), **values)
                units = {k: x for k, x in base.items() if k == "Units"}
                return _entry(OF_AGGREGATE_IN_GROUP if "group" in values else OF_AGGREGATE, base, kind=kind.capitalize(), **values) | units
    if m := re.fullmatch(r"n_(\w+)", name, re.ASCII):
        return _entry(OF_SUBJECTS, {}) if m[1] == "subjects" else _entry(OF_SUBJECTS_IN_GROUP, {}, group=m[1])
    return {}


def describe_columns(columns: list[str], known: dict[str, dict], tests: tuple[str, ...] = ()) -> dict[str, dict]:
    """A description for each column, empty where no rule applies."""
    return {c: describe_column(c, known, tests) for c in columns}

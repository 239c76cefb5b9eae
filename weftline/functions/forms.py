"""The stored form of events, by type: payload paths that are never stored, and fields that only some types have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.scalars import compact

#: Payload fields that a type's stored event leaves out; None: all of its payload.
STRIPPED = {"run_started": None, "step_started": ("input",)}
#: Fixed value: the one type whose event keeps its resume id.
RESUMES = "hook_received"


def stored_data(event_type: Column, data: Column) -> Column:
    """Payload (a JSON text) of the stored event: fields of its type taken out, the rest as it is; null without one.

    The payload is read as VARIANT, so values of any kind pass through; a payload that is
    no object has no fields to take out. Fields come in alphabetical order.
    """
    value = F.try_parse_json(data)
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    out = F.when(event_type.isin(*(t for t, f in STRIPPED.items() if f is None)), F.lit(None).cast("string"))
    for kind, names in STRIPPED.items():
        if names:
            left = F.map_filter(fields, lambda k, _: ~k.isin(*names))  # noqa: B023  used at once
            out = out.when((event_type == kind) & fields.isNotNull(), F.to_json(left))
    return out.otherwise(F.to_json(value))


def stored_event(event_type: Column, data: Column, resume_id: Column, **fields: Column) -> Column:
    """JSON of an event as it is stored: its payload's form by type, the resume id where the type has one, no absent fields."""
    kept = {
        "eventData": F.try_parse_json(stored_data(event_type, data)),
        "eventType": event_type,
        **fields,
        "resumeId": F.when(event_type == RESUMES, resume_id),
    }
    return compact(**dict(sorted(kept.items())))


def shown_hook(resolve: Column, metadata: Column) -> Column:
    """A hook's metadata as it is shown: nothing where data isn't to be resolved."""
    return F.when(F.coalesce(resolve, F.lit("all")) != "none", metadata)

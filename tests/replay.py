"""A plain, one-by-one replay of a patch log, to compare results with."""

import copy


def replay(entities, patches, fits, types_at):
    """``entities``: key -> value; ``patches``: (key, seq, op, path, value);
    ``fits(type, value)``; ``types_at(steps)`` -> type or None. Returns the new
    entities and the set of ``(key, seq, code)`` refused."""
    state = copy.deepcopy(entities)
    refused = set()
    for key, seq, op, path, value in sorted(patches, key=lambda p: (p[0], p[1])):
        steps = path.split("/")[1:] if path else []
        kind = types_at(steps) if (path == "" or path.startswith("/")) else None
        if op != "replace":
            refused.add((key, seq, "unsupported_op"))
        elif kind is None:
            refused.add((key, seq, "invalid_path"))
        elif not fits(kind, value):
            refused.add((key, seq, "invalid_patch"))
        elif key not in state:
            refused.add((key, seq, "unknown_entity"))
        elif not _set(state, key, steps, value):
            refused.add((key, seq, "invalid_path"))
    return state, refused


def _set(state, key, steps, value):
    holder, place = state, key
    for step in steps:
        holder = holder[place]
        if isinstance(holder, list):
            place = int(step)
            if place >= len(holder):
                return False
        else:
            place = step
    holder[place] = copy.deepcopy(value)
    return True

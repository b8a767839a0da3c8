"""Small replays of the documented upsert rules, used as test oracles."""

from __future__ import annotations


# ---------------------------------------------------------------- upsert models


def natural_replay(existing, rows):
    """existing: [(id, key)], rows: [(id, key, ok)] in order -> (state {key: id}, statuses)."""
    by_key, owner, st = {}, {}, []
    for i, k in existing:
        by_key[k] = i
        owner[i] = k
    for i, k, ok in rows:
        cur = by_key.get(k)
        h = owner.get(i)
        if h is not None and h != k:
            st.append("rejected")
            continue
        if cur is None and not ok:
            st.append("rejected")
            continue
        if cur is not None:
            owner.pop(cur, None)
        owner[i] = k
        by_key[k] = i
        st.append("inserted" if cur is None else "updated")
    return by_key, st


def ignore_replay(existing_ids, rows):
    """rows: [(id, payload, ok)] -> (stored {id: payload}, statuses)."""
    stored = {i: None for i in existing_ids}
    st = []
    for i, p, ok in rows:
        if i in stored:
            st.append("duplicate_noop")
        elif not ok:
            st.append("rejected")
        else:
            stored[i] = p
            st.append("inserted")
    return {k: v for k, v in stored.items() if v is not None}, st


def last_replay(rows):
    stored, st = {}, []
    for i, p, ok in rows:
        if not ok:
            st.append("rejected")
            continue
        st.append("updated" if i in stored else "inserted")
        stored[i] = p
    return stored, st

"""Checked access to Arrow arrays inside tasks."""

from __future__ import annotations


def equal_rows(lists, width: int, what: str):
    """The values of a list array as one flat NumPy array, ``width`` for each row.

    A row that is absent, has another length or holds a null is an error that names it:
    by the total alone a short row and a long one would pass and mix their values.
    """
    import numpy as np
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    wrong = np.flatnonzero(lengths != width)
    if len(wrong):
        row = int(wrong[0])
        found = "no" if lengths[row] < 0 else lengths[row]
        raise ValueError(f"every row must have {width} {what}; row {row} of its batch has {found}")
    flat = lists.flatten()
    if flat.null_count:
        row = int(np.flatnonzero(flat.is_null().to_numpy(zero_copy_only=False))[0]) // width
        raise ValueError(f"every row must have {width} {what}; row {row} of its batch has a null")
    return flat.to_numpy(zero_copy_only=False)


def class_labels(labels, classes: int):
    """Labels as NumPy integers; one that is absent or no class is an error."""
    import numpy as np

    if labels.null_count:
        row = int(np.flatnonzero(labels.is_null().to_numpy(zero_copy_only=False))[0])
        raise ValueError(f"row {row} of its batch has no label")
    found = labels.to_numpy(zero_copy_only=False)
    wrong = np.flatnonzero((found < 0) | (found >= classes))
    if len(wrong):
        row = int(wrong[0])
        raise ValueError(
            f"labels must be from 0 to {classes - 1}; row {row} of its batch has {found[row]}"
        )
    return found

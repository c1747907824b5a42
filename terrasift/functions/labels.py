"""Class names and labels taken from paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from terrasift.registry import IMAGE_CLASSES, UNKNOWN_LABEL


def class_name(class_id: Column, names=IMAGE_CLASSES) -> Column:
    """Name of a class id; ids outside the list become ``未知(id)``.

    The list of classes is configuration, not data, so it is a literal in the
    plan and no join is needed.
    """
    known = F.array(*[F.lit(n) for n in names])
    inside = class_id.between(0, len(names) - 1)
    unknown = F.concat(F.lit("未知("), class_id.cast("string"), F.lit(")"))
    return F.when(inside, F.try_element_at(known, (class_id + 1).cast("int"))).otherwise(unknown)


def class_id(name: Column, names=IMAGE_CLASSES) -> Column:
    """Position of a class name in the list, null for other names."""
    position = F.array_position(F.array(*[F.lit(n) for n in names]), name)
    return F.when(position > 0, (position - 1).cast("int"))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def parent_dir(path: Column) -> Column:
    """Directory that holds the file; a ``column=`` prefix of a partitioned
    write is dropped. Null when the path has no directory."""
    parent = F.try_element_at(F.split(path, "/"), F.lit(-2))
    return F.regexp_replace(parent, "^[^=]*=", "")


def label_from_path(path: Column, names=IMAGE_CLASSES, mode: str = "parent_dir") -> Column:
    """Label implied by a path.

    ``parent_dir`` trusts only the directory holding the file. ``substring``
    takes the first class whose name occurs anywhere in the path, so a data
    root that mentions a class labels everything below it with that class.
    """
    if mode == "parent_dir":
        holder = F.lower(parent_dir(path))
        hits = [F.when(holder == name.lower(), F.lit(name)) for name in names]
    elif mode == "substring":
        hits = [F.when(F.lower(path).contains(name.lower()), F.lit(name)) for name in names]
    else:
        raise ValueError(f"mode must be 'parent_dir' or 'substring', not {mode!r}")
    return F.coalesce(*hits, F.lit(UNKNOWN_LABEL))

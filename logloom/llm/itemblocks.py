"""Items numbered in the order in which they are met, and blocks of them as columns."""

import pyarrow as pa


class Numbers(dict):
    """Numbers items in the order they are first asked for; several may share a list of names."""

    def __init__(self, names: list[bytes]):
        self.names = names

    def __missing__(self, name: bytes) -> int:
        self[name] = number = len(self.names)
        self.names.append(name)
        return number


def one(values: pa.Array) -> pa.Array:
    """An array as the only element of a column."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def as_text(names: list[bytes]) -> pa.Array:
    return pa.array(names, pa.binary()).view(pa.string())

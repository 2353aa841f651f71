"""Run without installing the package on the workers."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_package() -> None:
    """Send the package's functions and processors to Python workers by value.

    Not needed where it is installed on the cluster or submitted with ``--py-files``.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])

"""Objects of this package as broadcast values: pickled with their classes, so executors need not have the package."""
from __future__ import annotations

import pickle

from pyspark import Broadcast, SparkContext, cloudpickle


def ship(context: SparkContext, value: object) -> Broadcast[bytes]:
    return context.broadcast(cloudpickle.dumps(value))


def unpack(shipped: Broadcast[bytes]):
    return pickle.loads(shipped.value)

"""Models of a Python worker.

A module of its own: the workers import it, so what it holds lives as long as the
worker, while the globals of a shipped closure last for one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Model = Callable[[np.ndarray], np.ndarray]

_models: dict[str, Model] = {}


def loaded(token: str, load: Callable[[], Model]) -> Model:
    """The model of `token`, which stands for its loader, loaded on first use; a worker keeps only the current one."""
    if token not in _models:
        _models.clear()
        _models[token] = load()
    return _models[token]

"""Batched model application on Spark workers (F1, F2).

``predict_batch_udf`` loads the model once per Python worker (the factory
runs lazily on the executor), feeds Arrow batches as numpy arrays and returns
one value -- or a struct of several outputs -- per row.  The caller brings
the model; a deterministic linear scorer is provided for tests and the bench.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import types as T

# Functions of this module travel to the Python workers by value, so the
# executors need no copy of this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def linear_weights(dim: int, outputs: int = 1, layer: int = 0):
    """Fixed weights ``w[i, j] = (((i + 3j + 5*layer) mod 11) - 5) / 10``."""
    import numpy as np
    i = np.arange(dim)[:, None]
    j = np.arange(outputs)[None, :]
    return (((i + 3 * j + 5 * layer) % 11) - 5) / 10.0


def linear_scorer(dim: int) -> Callable[[], Callable]:
    """A deterministic linear model (one score per row) for tests and the bench."""
    def make_predict_fn():
        import numpy as np
        w = linear_weights(dim, 1)[:, 0]

        def predict(x):
            return np.asarray(x, dtype=np.float64) @ w
        return predict
    return make_predict_fn


def linear_encoder(dim: int, outputs: int = 4, layers: int = 4) -> Callable[[], Callable]:
    """A model with ``layers`` outputs (final + side outputs), each a vector
    of ``outputs`` values."""
    names = ["final"] + [f"side{i}" for i in range(1, layers)]

    def make_predict_fn():
        import numpy as np
        ws = [linear_weights(dim, outputs, layer) for layer in range(layers)]

        def predict(x):
            x64 = np.asarray(x, dtype=np.float64)
            return {n: x64 @ w for n, w in zip(names, ws)}
        return predict
    return make_predict_fn


def encoder_return_type(outputs: int = 4, layers: int = 4) -> T.StructType:
    """Struct type of :func:`linear_encoder`'s outputs (final + side outputs)."""
    names = ["final"] + [f"side{i}" for i in range(1, layers)]
    return T.StructType([T.StructField(n, T.ArrayType(T.DoubleType())) for n in names])


def batch_predict(col: Column | str, make_predict_fn: Callable[[], Callable], return_type,
                  batch_size: int = 256, input_shape: list[int] | None = None) -> Column:
    """Apply a model factory to a column in Arrow batches (``predict_batch_udf``)."""
    from pyspark.ml.functions import predict_batch_udf
    shapes = [input_shape] if input_shape else None
    udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size,
                            input_tensor_shapes=shapes)
    return udf(col)


def decode_bytes(col: Column | str, decode: Callable[[bytes], dict | None], return_type: T.StructType) -> Column:
    """Apply a caller-supplied decoder (bytes -> dict of the struct's fields,
    or None for an invalid payload) to a binary column, in Arrow batches on
    the workers.  A decoder error yields a null row, never a failed task."""
    from pyspark.sql.functions import pandas_udf

    names = [f.name for f in return_type.fields]

    @pandas_udf(return_type)
    def _decode(s: pd.Series) -> pd.DataFrame:
        out = []
        for b in s:
            try:
                v = decode(bytes(b)) if b is not None else None
            except Exception:
                v = None
            out.append(v if v is not None else {n: None for n in names})
        return pd.DataFrame(out, columns=names)
    return _decode(col)


TOKENIZED = T.StructType([T.StructField("input_ids", T.ArrayType(T.IntegerType())),
                          T.StructField("error", T.StringType())])


def apply_tokenizer(messages: Column | str, add_generation: Column | str,
                    tokenize: Callable[[list, bool], list]) -> Column:
    """Caller-supplied chat template + tokenizer, applied in Arrow batches:
    ``tokenize(messages, add_generation_prompt) -> list[int]`` where
    ``messages`` is a list of ``{role, content: [{type, text, image_ref}]}``
    dicts.  Returns ``struct<input_ids, error>`` like the SQL stand-in; an
    exception becomes the row's ``error`` (the row is kept, as a reject)."""
    from pyspark.sql.functions import pandas_udf

    def plain(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        if isinstance(v, (list, tuple)):
            return [plain(x) for x in v]
        return v

    @pandas_udf(TOKENIZED)
    def _tok(msgs: pd.Series, gen: pd.Series) -> pd.DataFrame:
        ids, errs = [], []
        for m, g in zip(msgs, gen):
            try:
                ids.append([int(x) for x in tokenize(plain(m) if m is not None else [], bool(g))])
                errs.append(None)
            except Exception as exc:
                ids.append(None)
                errs.append(f"{type(exc).__name__}: {exc}"[:200])
        return pd.DataFrame({"input_ids": ids, "error": errs})
    return _tok(messages, add_generation)

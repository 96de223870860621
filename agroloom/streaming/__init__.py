"""Streams.

The reference data of crop mapping comes in batches, so no operator keeps state over a stream. The
expressions of :mod:`agroloom.functions` and the row-wise operators of
:mod:`agroloom.operators.inputs` hold no state either and take a streaming DataFrame as they are.
"""

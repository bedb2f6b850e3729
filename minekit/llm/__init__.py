"""Operators for corpora that language models are trained on.

Every operator takes DataFrames and column names, reads only the columns it names (so further columns may
have any name) and treats a null text as empty unless it says otherwise.
"""

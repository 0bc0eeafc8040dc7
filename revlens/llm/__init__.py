"""Training-data operators: one module per operator, ``queries`` registers them.

Nothing outside this folder imports it; deleting it leaves the rest of
the library whole.
"""

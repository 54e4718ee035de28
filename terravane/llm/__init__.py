"""Training-data operators: each module holds one operator with its own general interface.

``queries`` wires the operators to the driver's tables; nothing outside this
subpackage imports it.
"""

"""DataFrame -> DataFrame operators.

- ``rank``        exact ranks / k-smallest flags without a single-partition sort
- ``sampling``    weighted slots, weighted draw (binned join), uniform pool draw
- ``planning``    slots, shortfall, keyed top-up, provider, modifiers, composition
- ``generation``  request shaping, bulk generation (mapInArrow), reply extraction
- ``messages``    record assembly, system normalisation, chat/inference render
- ``tokens``      length cap (whitespace natively, or a tokenizer's spans)
- ``metrics``     attempts, successes, run summary
- ``split``       exact-size seeded split and the epoch batch manifest
"""

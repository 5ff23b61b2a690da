"""dialforge: build chat-format instruction datasets as Spark jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions (usable with ``df.transform``). Random choices are pure
functions of ``(seed, key, tag)`` so results do not depend on partitioning,
task retries or executor loss.

Sub-packages:

- ``functions``  column expressions: seeded draws, chat templates, tokens
- ``sources``    catalogue, modifiers, JSON Lines / Parquet record stores
- ``operators``  sampling, planning, generation, messages, metrics, split
- ``plans``      end-to-end jobs (build dataset, prepare training set)
- ``streaming``  wave-by-wave generation as a checkpointed streaming query
"""

__version__ = "0.1.0"

"""End-to-end jobs and the registered queries.

- ``build_dataset``     plan -> generate in waves -> records + failures (resumable)
- ``prepare_training``  records -> trim -> normalise -> render -> split -> cap, + manifest
- ``registry``          the queries behind ``__spark_entry__`` and their SQL twins
"""

from quarry.sinks.files import (  # noqa: F401
    OwnInputError, assert_not_reading, write_overwrite, write_update,
)

"""Writers: idempotent partition writes, landing, layout and run logs."""

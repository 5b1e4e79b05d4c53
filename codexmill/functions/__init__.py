"""Part of codexmill."""

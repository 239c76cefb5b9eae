"""Part of weftline."""

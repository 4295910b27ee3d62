"""DataFrame -> DataFrame operators (silver, gold, filters, serving, dims,
reshapes, month bookkeeping)."""

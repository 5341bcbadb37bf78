"""DataFrame-to-DataFrame operators; each works on a batch and on a micro-batch."""

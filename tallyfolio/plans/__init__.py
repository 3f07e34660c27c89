"""The returns themselves, composed from operators."""

"""Column expressions: identities, sizes, validation rules, states."""

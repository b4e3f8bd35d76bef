"""Rule packs and whole reporting jobs, composed from the operators."""

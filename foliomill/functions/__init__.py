"""Column expressions; everything stays JVM-side unless a module says otherwise."""

from sylvan.cli import main

raise SystemExit(main())
